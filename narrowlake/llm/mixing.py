"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import SPACED_WORD, stored, table

# Sources in code point order, null last, weigh these in turn.
WEIGHTS = (5.0, 2.0, 1.0)
# Share of all words that the mix holds, and the most copies of one document.
SHARE = 1.5
MOST_COPIES = 2
# Documents under this many words are drawn at half the odds of the others of their source.
SHORT_WORDS = 20
# Ranks are whole numbers of so many bits; a pass of the histogram cuts cells into 2**STEP_BITS.
RANK_BITS = 52
STEP_BITS = 11
IN_CELL = "rank >= low AND shiftright(rank - low, shift) = 0"
SEED = 20_011
# Documents that are taken to fill the gap of a source.
FILLERS = 8


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """The documents of the mix: every input row as often as the mix takes it.

    A source's target is its weight's part of ``share`` of all words, at most ``most``
    times its own words; the excess goes to the others by weight.  A source whose target
    is c whole times its words or more gives every document c certain copies.  The rest
    is a Pareto order sample: each document gets an inclusion probability p (half as much
    for short ones) and a uniform number u from a hash of its id and text, and ranks by
    (u / (1 - u)) / (p / (1 - p)).  The sample's fixed size is counted in words: documents
    are taken in rank order as long as they fit, then of those behind the cut, one after
    the other, the ones that fill the gap best, as long as they bring the source closer to
    its target and FILLERS at most.

    Ranks are never sorted as a whole: words per step of the rank are summed twice, then
    only the documents of one cell of each source meet in a window.  Only totals reach
    the driver.  Null and empty texts have no words and come with the certain copies
    alone.  Equal rows share a rank and are taken together.  A null source is a source.
    Without rows or words the mix is empty.  The columns are those of the input.
    """
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("row"), *_measured(docs, seed))
    sizes = stored(rows.drop("row"), "sizes")
    drawn = _drawn(rows, _cuts(sizes, weights, share, most))
    copies = drawn.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select("row.*")


def taken(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """The decisions of ``mix`` without texts: doc_id, size, source_size, target, taken per row."""
    sizes = stored(docs.select(*_measured(docs, seed)), "sizes")
    return _drawn(sizes, _cuts(sizes, weights, share, most)).select(
        "doc_id",
        F.col("words").alias("size"),
        F.col("total").alias("source_size"),
        "target",
        (F.col("words") * F.col("copies")).alias("taken"),
    )


def _measured(docs: DataFrame, seed: int) -> list[Column]:
    """doc_id, key (the source, never null), words and u, which depends on the row alone."""
    words = F.coalesce(F.regexp_count("text", F.lit(SPACED_WORD)), F.lit(0)).cast("long")
    # 53 bits, as many as a double holds, moved off 0 and 1.
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) + 0.5) / F.lit(2.0**53)
    key = F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))
    return [docs["doc_id"], key.alias("key"), words.alias("words"), u.alias("u")]


def _targets(sizes: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """(key, total, short, target) of each source."""
    short = F.col("words") < SHORT_WORDS
    sources = sizes.groupBy("key").agg(
        F.sum("words").alias("total"), F.sum(F.when(short, F.col("words")).otherwise(0)).alias("short")
    )
    # Places in code point order without one task: by ranges, then inside each range.
    ranged = stored(
        sources.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "sources"
    )
    before = ranged.groupBy("part").count().select(
        "part", F.expr("sum(count) OVER (ORDER BY part) - count").alias("before")
    )
    place = F.expr("before + row_number() OVER (PARTITION BY part ORDER BY key) - 1")
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    placed = stored(
        ranged.join(before, "part").select("key", "total", "short", weight.alias("weight")), "weights"
    )
    words = placed.agg(F.sum("total")).first()[0] or 0
    cap, level, full = F.col("total") * F.lit(most), 0.0, -1
    # Raise the level until it pushes no further source above its cap.
    while True:
        closed = cap <= F.col("weight") * level
        row = placed.agg(
            F.count(F.when(closed, 1)).alias("n"),
            F.sum(F.when(closed, cap)).alias("used"),
            F.sum(F.when(~closed, F.col("weight"))).alias("open"),
        ).first()
        if row["n"] == full or not row["open"]:
            break
        full, level = row["n"], (share * words - (row["used"] or 0)) / row["open"]
    return placed.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def _cuts(sizes: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """One row per source: its target, the chances of its documents and where its ranks are cut."""
    plan = _targets(sizes, weights, share, most)
    whole = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("int"))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("total"))
    long = F.col("total") - F.col("short")
    odds = F.coalesce(F.try_divide("rest", long + F.col("short") / 2), F.lit(0.0))
    over = F.coalesce(F.try_divide(F.col("rest") - long, F.col("short")), F.lit(0.0))
    plan = plan.withColumns(
        {
            "p_long": F.least(F.lit(1.0), odds),
            "p_short": F.when(odds <= 1, odds / 2).otherwise(F.least(F.lit(1.0), over)),
        }
    )
    certain = F.when(F.col("p_long") >= 1, long).otherwise(0) + F.when(
        F.col("p_short") >= 1, F.col("short")
    ).otherwise(0)
    plan = plan.withColumns(
        {"low": F.lit(0).cast("long"), "used": certain.cast("long"), "shift": F.lit(RANK_BITS)}
    )
    cut = stored(plan.drop("short", "weight"), "plan")
    # The cell that holds the cut: first among all ranks, then within that cell.
    for _ in range(2):
        cut = stored(_narrowed(sizes, cut), "cell")
    inside = _ranked(sizes, cut).where(f"words > 0 AND {IN_CELL}")
    inside = inside.withColumn("upto", F.expr("used + sum(words) OVER (PARTITION BY key ORDER BY rank)"))
    fits = inside.where("upto <= rest").groupBy("key")
    cut = cut.join(fits.agg(F.max("rank").alias("last"), F.max("upto").alias("reached")), "key", "left")
    cut = cut.withColumn("last", F.coalesce("last", F.col("low") - 1))
    cut = cut.withColumn("gap", F.col("rest") - F.coalesce("reached", "used"))
    cut = cut.withColumn("fillers", F.array().cast("array<bigint>"))
    cut = stored(cut.drop("low", "used", "shift", "reached"), "cut")
    for _ in range(FILLERS):
        behind = _ranked(sizes, cut).where("words > 0 AND rank > last AND words < 2 * gap AND NOT array_contains(fillers, rank)")
        # Equal rows share a rank and are taken together.
        ranks = behind.groupBy("key", "rank", "gap").agg(F.sum("words").alias("words")).where("words < 2 * gap")
        best = F.min(F.struct(F.abs(F.col("words") - F.col("gap")).alias("off"), "rank", "words")).alias("best")
        found = stored(ranks.groupBy("key").agg(best), "filler")
        if found.isEmpty():
            break
        more = F.when(F.col("best").isNotNull(), F.array("best.rank")).otherwise(F.array().cast("array<bigint>"))
        cut = cut.join(found, "key", "left").withColumns(
            {"fillers": F.concat("fillers", more), "gap": F.col("gap") - F.coalesce("best.words", F.lit(0))}
        )
        cut = stored(cut.drop("best"), "cuts")
    return cut


def _ranked(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with words, their source's plan, and the Pareto rank as a whole number.

    The odds ratio q is put on a bounded scale as q / (1 + q), which keeps its order.
    Certain documents rank at -1, before all others.
    """
    rows = sizes.join(plan, "key")
    p = F.when(F.col("words") < SHORT_WORDS, F.col("p_short")).otherwise(F.col("p_long"))
    out = F.col("u") * (1 - p)
    scaled = F.floor(out / (out + p * (1 - F.col("u"))) * F.lit(2.0**RANK_BITS))
    top = F.lit(2**RANK_BITS - 1).cast("long")
    return rows.withColumn("rank", F.when(p >= 1, F.lit(-1)).otherwise(F.least(scaled, top)).cast("long"))


def _narrowed(sizes: DataFrame, cut: DataFrame) -> DataFrame:
    """The cell, STEP_BITS finer than the last one, in which the words of each source run out."""
    finer = cut.withColumn("shift", F.col("shift") - STEP_BITS)
    rows = _ranked(sizes, cut.where("rest > 0")).where(f"words > 0 AND {IN_CELL}")
    step = F.expr(f"shiftright(rank - low, shift - {STEP_BITS})")
    cells = rows.groupBy("key", "rest", "used", step.alias("step")).agg(F.sum("words").alias("words"))
    sums = cells.withColumn("upto", F.expr("used + sum(words) OVER (PARTITION BY key ORDER BY step)"))
    at = sums.where("upto > rest").groupBy("key").agg(
        F.min(F.struct("step", (F.col("upto") - F.col("words")).alias("before"))).alias("at"),
    )
    # Where words never run out all are taken: a cell above all ranks.
    above = F.when(F.col("rest") > 0, F.lit(2**RANK_BITS)).otherwise(F.lit(-1)).cast("long")
    return finer.join(at, "key", "left").select(
        *[c for c in cut.columns if c not in ("low", "used", "shift")],
        F.when(F.col("at").isNotNull(), F.col("low") + F.expr("shiftleft(at.step, shift)"))
        .otherwise(above)
        .alias("low"),
        F.coalesce(F.col("at.before"), F.when(F.col("rest") > 0, F.col("total")).otherwise(0))
        .cast("long")
        .alias("used"),
        "shift",
    )


def _drawn(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Every row with the number of its copies."""
    drawn = F.expr("words > 0 AND (rank <= last OR array_contains(fillers, rank))").cast("int")
    return _ranked(rows, cuts).withColumn("copies", F.col("whole") + drawn)


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return taken(table(spark, folder, "documents"))
