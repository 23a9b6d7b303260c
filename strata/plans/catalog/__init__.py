"""The query catalogue: every operator exercised on the driver tables."""
from strata.plans.catalog import checks, cleaning, envelope, model, recipes, stream  # noqa: F401  (registration)
from strata.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
