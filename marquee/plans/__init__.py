"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Importing this package imports every plan module so the registry is full.
"""

from marquee.plans.registry import QUERIES, ORACLE_SQL, query  # noqa: F401
from marquee.plans import (  # noqa: F401
    listing, warehouse, conform, text_ops, curation, lines_ops, records_ops, sources_ops, places_ops, operator_ops, members_ops, issues_ops,
)
