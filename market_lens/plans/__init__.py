"""Registered queries; importing the package registers them."""

from market_lens.plans import (  # noqa: F401
    cleaning_queries,
    coverage_queries,
    model_queries,
    source_queries,
    stats_queries,
    text_queries,
)
from market_lens.plans.registry import CHECKS, QUERIES  # noqa: F401
