"""Every query over the given tables, next to the SQL it has to agree with."""

from kinfold.catalog.base import QUERIES, SQL
from kinfold.catalog import files, households, joins, models, scores, shapes, survey  # noqa: F401  (they register themselves)

__all__ = ["QUERIES", "SQL"]
