"""Sample filings.  Values follow from row numbers, so a drop can be made again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.model import COLLECTIONS, KV
from narrowlake.operators.joins import assign_codes

# The filings of the sample drops, (series, as-of date, institution).
KV_FILINGS = (
    ("FRY9C", "20230131", "1234567"),
    ("FRY9C", "20231231", "2345678"),
    ("FRY15", "20241231", "2345678"),
)
COLLECTIONS_FILINGS = (*KV_FILINGS, ("FR2004A", "20241231", "2345678"))

# Ranges of the sample values.
KV_VALUES = (1000, 999999)
COLLECTIONS_VALUES = (1000, 9999999)


def spread(seed: Column, low: int, high: int) -> Column:
    """A repeatable number in [low, high]."""
    return F.pmod(F.xxhash64(seed), F.lit(high - low + 1)) + low


def _filing_rows(spark: SparkSession, n: int, filing: tuple[str, str, str]) -> DataFrame:
    series, aod, rssdid = filing
    return spark.range(n).select(
        F.col("id").alias("row_no"),
        F.lit(series).alias("seriesid"),
        F.lit(aod).alias("aod"),
        F.lit(rssdid).alias("rssdid"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def gen_kv(spark: SparkSession, n: int = 1000) -> DataFrame:
    """One filing, the same keys submitted again, and a filing of a second series."""

    def block(first: int, series: str, submission: str, key: str, value: str) -> DataFrame:
        number = F.col("id").cast("string")
        return spark.range(first, first + n).select(
            F.lit(series).alias("seriesid"),
            F.lit("aod_set1").alias("aod"),
            F.lit("rssdid_set1").alias("rssdid"),
            F.lit(submission).alias("submissionts"),
            F.concat(F.lit(key), number).alias("key"),
            F.concat(F.lit(value), number).alias("value"),
        )

    # Names of the sample rows.
    return _union(
        [
            block(1, "seriesid_set1", "submissionts_set1", "key_", "value_"),
            block(1, "seriesid_set1", "submissionts_set2", "key_", "value_changed_"),
            block(n + 1, "seriesid_set2", "submissionts_set1", "key_set2_", "value_set2_"),
        ]
    )


def gen_kv_codes(
    spark: SparkSession, codes: dict[str, DataFrame], n: int = 1000, ts: int = 1740000002
) -> DataFrame:
    """Filings whose keys cycle through the code list of their series."""
    blocks = []
    for filing in KV_FILINGS:
        rows = assign_codes(
            _filing_rows(spark, n, filing), codes[filing[0]], row_id=F.col("row_no"), order="code"
        )
        blocks.append(
            rows.select(
                "seriesid",
                "aod",
                "rssdid",
                F.lit(str(ts)).alias("submissionts"),
                F.col("code").alias("key"),
                spread(F.concat_ws("|", "seriesid", "aod", "row_no"), *KV_VALUES)
                .cast("string")
                .alias("value"),
            )
        )
    return _union(blocks).select(*KV.columns)


def gen_collections(
    spark: SparkSession, dictionaries: dict[str, DataFrame], n: int = 1000, ts: int = 1740000002
) -> DataFrame:
    """Filings whose items and level-1 context cycle through a dictionary."""
    blocks = []
    for filing in COLLECTIONS_FILINGS:
        rows = assign_codes(
            _filing_rows(spark, n, filing),
            dictionaries[filing[0]],
            row_id=F.col("row_no"),
            order="item_mdrm",
        )
        blocks.append(
            rows.withColumns(
                {
                    "submission_ts": F.lit(str(ts)),
                    "item_value": spread(
                        F.concat_ws("|", "seriesid", "aod", "row_no"), *COLLECTIONS_VALUES
                    ).cast("string"),
                    **{
                        c: F.lit("")
                        for level in COLLECTIONS.contexts[1:]
                        for c in (level.code, level.desc, level.value)
                    },
                }
            )
        )
    return _union(blocks).select(*COLLECTIONS.columns)
