"""Hadoop S3A options from the environment."""

from __future__ import annotations

from collections.abc import Mapping

# Environment names of the endpoint host, its port and the two keys.
ENDPOINT, PORT = "S3_ENDPOINT_URL", "BUCKET_PORT"
ACCESS_KEY, SECRET_KEY = "AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY"


def s3a_options(env: Mapping[str, str], ssl: bool = False) -> dict[str, str]:
    """Session options for a path-style object store; empty where no endpoint is named.

    Values go to the session builder and nowhere else; a missing name is reported by name only.
    """
    if ENDPOINT not in env:
        return {}
    missing = [name for name in (PORT, ACCESS_KEY, SECRET_KEY) if name not in env]
    if missing:
        raise KeyError(f"object store settings missing: {', '.join(missing)}")
    prefix = "spark.hadoop.fs.s3a."
    return {
        prefix + "endpoint": f"{env[ENDPOINT]}:{env[PORT]}",
        prefix + "access.key": env[ACCESS_KEY],
        prefix + "secret.key": env[SECRET_KEY],
        prefix + "path.style.access": "true",
        prefix + "connection.ssl.enabled": "true" if ssl else "false",
    }
