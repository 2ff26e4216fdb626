"""All registered queries."""

from newsalpha.catalog import joins, learning, rows, sources, summaries  # noqa: F401
from newsalpha.catalog.base import ORACLES, QUERIES  # noqa: F401
