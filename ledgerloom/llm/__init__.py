"""Operators for large training-data corpora and their registered queries."""

from . import decontaminate, fill_middle, filter_audit, host_rules, jaccard_join, licenses, maxent, mixing, packing, repeats, sharding, token_counts, toxicity  # noqa: F401
from .common import ORACLES, QUERIES  # noqa: F401
