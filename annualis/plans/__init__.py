"""Registered queries; importing the package registers all of them."""

from annualis.plans import q_cases, q_cleaning, q_io, q_joins, q_models, q_rates, q_series, q_stats  # noqa: F401
from annualis.plans.catalog import ORACLE, QUERIES  # noqa: F401
