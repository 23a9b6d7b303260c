from strata.operators import dedup, profile, quality, reshape, star
from strata.operators.dedup import keep_one_per_key, latest_per_key
from strata.operators.quality import Check, QualityGateError, contract_report, enforce, require_columns, run_checks

__all__ = [n for n in dir() if not n.startswith("_")]
