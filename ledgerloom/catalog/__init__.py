"""All registered queries."""

from . import edges, graphs, tables, transactions  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
