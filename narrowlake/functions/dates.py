from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(col: Column | str) -> Column:
    """An as-of date written as 20230131 or 2023-01-31; NULL if it is neither."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.try_to_date(text, "yyyyMMdd"), F.try_to_date(text, "yyyy-MM-dd"))
