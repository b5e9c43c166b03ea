"""Small helpers shared by the column-function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def py_text(c) -> Column:
    """Render a value the way a Python f-string would: null → ``None``."""
    return F.coalesce(as_col(c).cast("string"), F.lit("None"))
