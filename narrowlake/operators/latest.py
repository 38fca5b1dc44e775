"""Current state and state as of an ingest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrowlake.functions.files import before_ingest
from narrowlake.model import COLLECTIONS, UNKNOWN_INGEST, Roles
from narrowlake.operators.pivots import grouped


def latest_submission(
    narrow: DataFrame, roles: Roles = COLLECTIONS, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The row of the latest submission for every (filing, item).

    The first row of a window ordered by submission, ingest time and the
    tie-break, all descending, taken as one maximum: it combines on the map
    side, so no group is ever sorted in one task however many rows it has.
    Remaining columns decide last, which makes the choice total.
    """
    keys = [*roles.filing_keys, roles.item]
    order = [roles.submission, roles.ingest, *(tie_break or (roles.value,))]
    rest = [c for c in narrow.columns if c not in {*keys, *order}]
    newest = grouped(narrow, *keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*narrow.columns)


def as_of_ingest(narrow: DataFrame, ingest: str, roles: Roles = COLLECTIONS) -> DataFrame:
    """The table as it stood after an ingest: a filter on the partition column.

    Times compare as numbers if both are; rows of an unknown time are left out.
    """
    own = F.col(roles.ingest)
    return narrow.where((own == ingest) | before_ingest(own, ingest)).where(own != UNKNOWN_INGEST)
