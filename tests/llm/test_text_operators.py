"""Operators on single texts, against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import time
import zlib

import numpy as np
import pytest

from ledgerloom.llm import pii, secrets, tokens, toxicity

KINDS1 = ("assign", "access", "hex")
KINDS5 = ("email", "ip", "card", "phone")


def luhn(d):
    return sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(d[::-1])) % 10 == 0


def plain_secrets(t):
    t = t or ""
    out = []
    for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A
    ):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def plain_pii(t):
    t = t or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def fuzz(pieces, n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(pieces) for _ in range(r.randint(0, 30))) for _ in range(n)]


SECRET_PIECES = [
    "password", "PassWd", "toKen", "api_key", "APIKEY", "ſecret", "secret", '"', "'", " ", ":", "=", "abcdef012345",
    "AKIA", "ABCD1234", "Z", "deadbeef", "é", "😀", "0", "=/+_.", "\n", "Xy9",
]
PII_PIECES = [
    "a@b.co", "_x@d.ef", "@", ".", "joe", "x-y.z", "10", "255", "256", "0001", "1.2.3.4", "+", "(", ")", "-", " ",
    "4111 1111 1111 1111", "4111111111111112", "555", "12345678901", "é", "😀", "%", "\n", "card ", "phone ",
]


def check_spans(rows, texts, plain, kinds):
    for row in rows:
        text = texts[row["doc_id"]]
        want = plain(text)
        for i, kind in enumerate(kinds):
            assert row[f"n_{kind}"] == sum(k == i for _, k, _ in want), (text, kind)
        assert row["base_sha256"] == digest(want, kinds), text
        found = row["spans"].split(",") if row["spans"] else []
        assert {f"{kinds[k]}:{s}:{e}" for s, k, e in want} <= set(found)


@pytest.mark.parametrize(
    "pieces, plain, kinds, operator",
    [
        (SECRET_PIECES, plain_secrets, KINDS1, secrets.find_secrets),
        (PII_PIECES, plain_pii, KINDS5, lambda df: pii.digest(pii.find_pii(df))),
    ],
)
def test_base_spans_equal_the_plain_patterns(documents, sample, odd_texts, pieces, plain, kinds, operator):
    texts = [*odd_texts, *fuzz(pieces, 1500, 1)]
    texts += ["1" * 20000, "1.2." * 5000, "a." * 9000 + "@b", "+1" + "(" * 9000, "password" + " " * 9000 + "x"]
    check_spans(operator(documents(texts)).collect(), dict(enumerate(texts)), plain, kinds)
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    check_spans(operator(sample).collect(), texts, plain, kinds)


def test_novel_strings_in_a_sensitive_context_are_reported():
    r, novelty = random.Random(3), secrets.Novelty()
    key = "".join(r.choice(string.ascii_letters + string.digits) for _ in range(40))
    text = f"authorization header Bearer {key} end"
    start = text.index(key)
    assert secrets.scan(text, novelty) == [(start, 3, start + 40)]
    assert secrets.scan(f"the code is {key} end", novelty) == []  # nothing sensitive beside it
    assert secrets.scan("bearer client_id_configuration_parameter1 then", novelty) == []
    # A copy in an ordinary place makes it no less of a secret.
    assert secrets.scan(f"{key} and again token {key}", novelty) == [(57, 3, 97)]
    assert secrets.redacted(text, secrets.scan(text, novelty)) == "authorization header Bearer [SECRET] end"


def random_key(n, seed, letters=string.ascii_letters + string.digits):
    r = random.Random(seed)
    return "".join(r.choice(letters) for _ in range(n))


@pytest.mark.parametrize(
    "secret",
    [
        random_key(900, 1), random_key(5000, 2), ".".join(random_key(n, 3) for n in (36, 200, 43)),
        "settings." * 60 + random_key(40, 4), random_key(30, 5) + "deadbeef01234567" + random_key(30, 6),
    ],
)
def test_long_and_joined_secrets_are_reported_in_whole(secret):
    novelty = secrets.Novelty()
    text = f"authorization: bearer {secret} end"
    found = secrets.scan(text, novelty)
    assert (22, 3, 22 + len(secret)) in found
    assert secrets.redacted(text, found) == "authorization: bearer [SECRET] end"


@pytest.mark.parametrize("n", [16, 24, 40, 300, 700])
def test_secrets_stated_twice_are_reported_each_time(n):
    key, novelty = "Q7" + random_key(n - 2, 11), secrets.Novelty()
    for text in (f"bearer {key}\n" * 2, f"auth {key} and\ncredential={key};\n", f"passwd={key}\nbearer {key}\n"):
        found = secrets.scan(text, novelty)
        assert len(found) == 2 and key not in secrets.redacted(text, found)
    words = "bearer client_id_configuration_parameter1 then\n"
    assert secrets.scan(words * 2, novelty) == []


@pytest.mark.parametrize("n", [16, 40, 300])
@pytest.mark.parametrize("gap", [0, 40, 250, 256, 400])
def test_a_copy_in_an_ordinary_place_hides_no_secret_and_is_redacted(n, gap):
    key, novelty = "Q7" + random_key(n - 2, 12), secrets.Novelty()
    fill = ("and so on with the words of the line " * 12)[:gap]
    for text in (f"id {key} end of line {fill}\nbearer {key}\n", f"bearer {key}\n{fill} id {key} end"):
        found = secrets.scan(text, novelty)
        assert {text[s:e] for s, _, e in found} == {key}
        clean = secrets.redacted(text, found)
        assert key not in clean and clean.count(secrets.MARK) == 2
    assert secrets.redacted("password=abcdefghij123 or abcdefghij123", [(0, 0, 22)]) == "[SECRET] or [SECRET]"


def test_a_name_that_stands_twice_is_no_secret():
    novelty = secrets.Novelty()
    line = "the token client_id_configuration_parameter is read from client_id_configuration_parameter\n"
    assert secrets.scan(line * 3, novelty) == []


@pytest.mark.parametrize("letters", [string.ascii_letters, string.ascii_lowercase, string.ascii_uppercase])
def test_secrets_of_letters_alone_are_reported(letters):
    novelty, lost = secrets.Novelty(), 0
    for i in range(100):
        key = random_key(20, 50 + i, letters)
        lost += (7, 3, 27) not in secrets.scan(f"bearer {key} end", novelty)
    assert lost <= 2
    prose = (
        "the client sends it in a header of the request with every call that it makes to the server as {} "
        "and after that the answer comes back with a status and a body that hold what was asked for or why not"
    )
    names = ["_refresh_interval_seconds", "invalid_request_error_message_text"]
    assert [n for n in names if secrets.scan(prose.format(f"token {n}"), novelty)] == []


def test_iban_and_context_words(documents):
    texts = [
        "account DE89 3704 0044 0532 0130 00 here", "DE89 3704 0044 0532 0130 01", "ssn 123-45-6789", "see 123-45-6789",
    ]
    rows = {r["doc_id"]: r for r in pii.digest(pii.find_pii(documents(texts))).collect()}
    assert rows[0]["spans"] == "iban:8:35" and rows[0]["scores"] == "1.10"
    assert rows[1]["n_iban"] == 0
    assert rows[2]["spans"] == "ssn:4:15" and rows[3]["spans"] == ""


def best_split(word, scores, least):
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(best[end - 1][0] + n * least, best[end - 1][1] - n)]
        for start in range(end):
            if word[start:end] in scores:
                options.append((best[start][0] + scores[word[start:end]], best[start][1] - 1))
        best[end] = max(options)
    return -best[-1][1], best[-1][0]


def test_token_counts_equal_a_table_per_word(documents, odd_texts, sample):
    scores = tokens.unigram_scores()
    least = min(scores.values()) - 1
    texts = [t for t in odd_texts if t is None or len(t) < 10000] + [r["text"] for r in sample.limit(40).collect()]
    for row in tokens.count_tokens(documents(texts)).collect():
        own = re.findall(r"[^\x20\x09-\x0D]+", texts[row["doc_id"]] or "")
        each = [best_split("▁" + w, scores, least) for w in own]
        assert (row["n_words"], row["n_tokens"]) == (len(own), sum(n for n, _ in each))
        assert math.isclose(row["log_score"], sum(s for _, s in each), abs_tol=1e-6)


def test_a_small_trie_counts_the_same():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -3.0, "abab": -4.5, "▁a": -2.5}
    large, small = tokens.Trie(scores), tokens.Trie(scores, max_nodes=2)
    for word in ("▁abab", "▁ab", "▁abb", "▁ba", "▁", "▁c", "▁ababab"):
        assert large.insert(word) == small.insert(word) == large.insert(word)
        assert large.insert(word)[0] == best_split(word, scores, large.least)[0]


def test_ftrl_equals_a_scalar_version():
    r = random.Random(5)
    model = toxicity.Ftrl(4)
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(z[i]) <= model.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * model.l1) / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)

    for _ in range(300):
        own, label = sorted(r.sample(range(17), 5)), r.randint(0, 1)
        w = [weight(i) for i in own]
        g = 1 / (1 + math.exp(-sum(w))) - label
        for i, x in zip(own, w):
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / model.alpha
            z[i] += g - sigma * x
            n[i] += g * g
        model.step(np.array(own), label)
    assert np.allclose(model.weights(), [weight(i) for i in range(17)])


def test_features_are_words_pairs_and_skips():
    at, coordinate = toxicity.features(["a b c", "", None, "A, b c!", "c b"])
    own = [set(coordinate[at == i]) for i in range(5)]
    assert len(own[0]) == 12 and own[0] == own[3] and own[1] == own[2] == set() and len(own[4]) == 7


def auc(pairs):
    ranked = sorted(pairs)
    positive = sum(y for _, y in pairs)
    return (sum(i + 1 for i, (_, y) in enumerate(ranked) if y) - positive * (positive + 1) / 2) / (
        positive * (len(pairs) - positive)
    )


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.toxicity(documents, labels).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    right = sum((s >= 0.5) == y for s, y in held) / len(held)
    assert auc(held) > 0.95 and right > 0.95


def test_labels_never_reach_held_out_rows_or_scores(spark, documents):
    texts = ["good fine words", "bad vile words"] * 40
    df = documents(texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    flipped = spark.createDataFrame(
        [(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(80)] + [(None, 1), (3, None)],
        "doc_id long, toxic int",
    )
    score = lambda l: {r["doc_id"]: r["score"] for r in toxicity.toxicity(df, l).collect()}  # noqa: E731, E741
    assert score(labels) == score(flipped)
    assert all((s >= 0.5) == i % 2 for i, s in score(labels).items())


@pytest.mark.parametrize(
    "operator",
    [
        secrets.find_secrets, tokens.count_tokens, pii.find_pii,
        lambda df: toxicity.toxicity(df, df.selectExpr("doc_id", "0 as toxic")),
    ],
    ids=["secrets", "tokens", "pii", "toxicity"],
)
def test_odd_rows_keep_a_row_each(odd, none, operator):
    out = operator(odd)
    assert sorted(map(str, (r[0] for r in out.collect()))) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert operator(none).count() == 0


def test_personal_data_in_long_texts_with_many_matches(documents):
    """Matches on either side of the blocks' ends, with context words before some of them."""
    r = random.Random(6)
    email = lambda i: f"user{i}@mail{i % 7}.example.org"
    numbers = lambda i: r.choice(["10.0.0.%d" % (i % 256), "+1 (555) 010-%04d" % i, "4111 1111 1111 1111", "host 1.2.3.4", "ssn 123-45-6789"])
    long = " ".join(r.choice([email(i), numbers(i), "tëxt", "call me"]) for i in range(1500))
    texts = [long, ",".join(email(i) for i in range(pii.BLOCK * 2 + 1)), ";".join(map(email, range(pii.BLOCK))), "é" + long]
    rows = {x["doc_id"]: x["pii"] for x in pii.find_pii(documents(texts)).collect()}
    for i, text in enumerate(texts):
        by_kind = {}
        for kind, (pattern, base, near) in pii.KINDS.items():
            for m in re.finditer(pattern.replace(r"|\G", ""), text):
                by_kind[kind, m.start(), m.end()] = base + 0.2 * bool(re.search(near, text[max(0, m.start() - 40) : m.start()], re.I))
        found = {(s["kind"], s["start"], s["end"]): s["score"] for s in rows[i]}
        assert len(found) == len(rows[i]) > 100
        for key, score in found.items():
            assert abs(by_kind[key] - score) < 1e-9
        assert {k for k in by_kind if k[0] in ("email", "ip")} == {k for k in found if k[0] in ("email", "ip")}


def test_work_on_personal_data_grows_with_the_text(documents):
    def seconds(n):
        df = documents([", ".join(f"user{i}@mail.example.org" for i in range(n))]).persist()
        df.count()
        start = time.perf_counter()
        assert len(pii.find_pii(df).first()["pii"]) == n
        taken = time.perf_counter() - start
        df.unpersist()
        return taken

    seconds(4000)
    assert seconds(32000) < 3 * seconds(16000) + 1


def test_contract_columns_come_first(documents):
    df = documents(["token = abcdefghij0123456789", "a@b.cd"])
    assert secrets.find_secrets(df).columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert pii.digest(pii.find_pii(df)).columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
