"""The registered queries: each operator on the given tables, with the SQL that states its answer."""

from daybook.queries.registry import QUERIES, SQL, load
from daybook.queries import cleaning, kpi, plant, upserts, workbooks  # noqa: F401  (they register themselves)

__all__ = ["QUERIES", "SQL", "load"]
