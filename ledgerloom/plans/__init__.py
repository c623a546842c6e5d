"""The end queries. Every source argument is raw lines or a typed table."""

from ledgerloom.plans.blocks import top_miners_by_size
from ledgerloom.plans.contracts import (
    monthly_avg_contract_gas,
    top_addresses_by_value,
    top_gas_months,
)
from ledgerloom.plans.monthly import (
    monthly_avg_gas_price,
    monthly_avg_value,
    monthly_count,
    monthly_summary,
)
from ledgerloom.plans.scams import (
    SERIES_CATEGORIES,
    scam_series,
    scam_totals,
    top_scam_categories,
    top_scam_ids,
)
from ledgerloom.plans.series import sorted_series

__all__ = [
    "SERIES_CATEGORIES",
    "monthly_avg_contract_gas",
    "monthly_avg_gas_price",
    "monthly_avg_value",
    "monthly_count",
    "monthly_summary",
    "scam_series",
    "scam_totals",
    "sorted_series",
    "top_addresses_by_value",
    "top_gas_months",
    "top_miners_by_size",
    "top_scam_categories",
    "top_scam_ids",
]
