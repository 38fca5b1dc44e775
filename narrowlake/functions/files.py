"""Expressions over file names and over the first bytes of a file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from narrowlake.model import UNKNOWN_INGEST

# Fixed value: bytes of a file that are looked at before it is accepted.
SAMPLE_BYTES = 1024


def ingest_ts(path: Column) -> Column:
    """Value of the ``ingest_ts=`` folder in a path; plain searches, as it may be asked for every row."""
    behind = F.split_part(F.concat(F.lit("/"), path), F.lit("/ingest_ts="), F.lit(2))
    found = F.substring_index(F.substring_index(behind, "/", 1), "=", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(UNKNOWN_INGEST))


def before_ingest(ingest: Column, bound: str) -> Column:
    """Whether an ingest time lies before a bound: as numbers if both are, else as text.

    A file whose path names no time has an unknown one, which is never before.
    """
    number = ingest.try_cast("decimal(38,0)")
    as_number = F.lit(bound).try_cast("decimal(38,0)")
    earlier = F.coalesce(number < as_number, ingest < bound)
    return F.when(ingest == UNKNOWN_INGEST, F.lit(False)).otherwise(earlier)


def file_path(uri: Column) -> Column:
    """A path as listings name it, from the encoded form row metadata has."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri, F.lit("%")), decoded).otherwise(uri)


def sample_md5(head: Column) -> Column:
    return F.md5(head)


def _utf8(head: Column) -> Column:
    # A character may be cut where the sample ends, so up to three trailing bytes
    # of a full sample may be left out.
    cut = F.length(head) == SAMPLE_BYTES
    whole = F.is_valid_utf8(head.cast("string"))
    shorter = [
        cut & F.is_valid_utf8(F.substring(head, 1, SAMPLE_BYTES - n).cast("string"))
        for n in (1, 2, 3)
    ]
    return reduce(lambda a, b: a | b, shorter, whole)


def looks_like_csv(head: Column) -> Column:
    """Whether a file may be read: UTF-8, some delimiter, first line not empty."""
    text = head.cast("string")
    return F.coalesce(
        (F.length(head) > 0) & _utf8(head) & text.rlike("[,;\t]") & ~text.rlike("^[\r\n]"),
        F.lit(False),
    )
