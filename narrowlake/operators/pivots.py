"""Narrow to wide and back.

Two physical forms give the same rows:

* ``case``: one conditional maximum per column.  One shuffle on the filing keys
  after a map-side combine.  Columns the caller does not select are pruned away,
  so it is the form for views and for narrow output.
* ``block``: maximum per (filing, item) first, then the cells of a filing in column order, by blocks of columns.
  The work per input row does not depend on the number of columns, and a filing
  that holds a large share of all rows is cut down to at most one row per item,
  spread over all tasks, before its rows meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.functions.cells import encode_cell, quoted, text_literal
from narrowlake.model import COLLECTIONS, KV, Roles

# Widest output the case form is picked for.
CASE_MAX_COLUMNS = 40
# Columns of the block form whose places are one array.
BLOCK_COLUMNS = 64


class PivotError(ValueError):
    """The distinct item codes can not become columns of one relation."""


def max_columns(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.pivotMaxValues"))


def items_by_series(narrow: DataFrame, roles: Roles = COLLECTIONS) -> DataFrame:
    """Sorted distinct item codes of every series, in one pass over the table.

    Duplicates are removed before anything is gathered, so a series of any size
    adds no more than its distinct codes to a group.
    """
    return (
        narrow.groupBy(F.col(roles.series), F.col(roles.item))
        .agg(F.lit(1).alias("_seen"))
        .groupBy(roles.series)
        .agg(F.sort_array(F.collect_list(roles.item)).alias("items"))
    )


def discover_items(narrow: DataFrame, roles: Roles = COLLECTIONS) -> dict[str, list[str]]:
    """Item codes per series on the driver, never more than the column limit each.

    One scan finds the distinct pairs; their number is checked before any code is
    fetched.
    """
    limit = max_columns(narrow.sparkSession)
    pairs = (
        narrow.select(roles.series, F.col(roles.item).cast("string").alias(roles.item))
        .where(F.col(roles.series).isNotNull())
        .distinct()
        .persist()
    )
    try:
        counts = pairs.groupBy(roles.series).agg(F.count(roles.item).alias("n"))
        for series, n in counts.where(F.col("n") > limit).take(1):
            raise PivotError(f"series {series!r} has {n} item codes, the limit is {limit}")
        found: dict[str, list[str]] = {}
        for series, code in pairs.collect():
            codes = found.setdefault(series, [])
            if code is not None:
                codes.append(code)
    finally:
        pairs.unpersist()
    return {series: sorted(codes) for series, codes in sorted(found.items())}


def discover_codes(rows: DataFrame, item: str) -> list[str]:
    """Sorted distinct codes of one relation, within the column limit."""
    limit = max_columns(rows.sparkSession)
    codes = [
        r[0]
        for r in rows.select(F.col(item).cast("string").alias("_code"))
        .where("_code IS NOT NULL")
        .distinct()
        .limit(limit + 1)
        .collect()
    ]
    if len(codes) > limit:
        raise PivotError(f"more than {limit} distinct values of {item!r}")
    return sorted(codes)


def check_columns(codes: Sequence[str], reserved: Sequence[str], *, sensitive: bool = False) -> None:
    """Refuse codes that would give a relation two columns of one name."""
    seen: dict[str, str] = {}
    for name in (*reserved, *codes):
        folded = name if sensitive else name.lower()
        if folded in seen:
            raise PivotError(f"columns {seen[folded]!r} and {name!r} can not be told apart")
        seen[folded] = name


def pivot(
    narrow: DataFrame,
    cell: Column,
    codes: Sequence[str],
    *,
    keys: Sequence[str],
    item: str | Column,
    extra_max: Sequence[str] = (),
    form: str = "auto",
) -> DataFrame:
    """One row per ``keys``, one column per code holding the largest cell.

    Rows with a NULL or unlisted code still give their filing a row.  ``extra_max``
    names columns whose maximum over the filing is kept next to the keys.
    """
    spark = narrow.sparkSession
    check_columns(
        codes,
        [*keys, *extra_max],
        sensitive=spark.conf.get("spark.sql.caseSensitive").lower() == "true",
    )
    if form == "auto":
        form = "block" if len(codes) > CASE_MAX_COLUMNS else "case"
    # Codes of any type become column names, so they compare as text.
    item = (F.col(item) if isinstance(item, str) else item).cast("string")
    rows = narrow.select(*keys, item.alias("_item"), cell.alias("_cell"), *extra_max)
    if form == "case":
        return _case_form(rows, codes, keys, extra_max)
    if form == "block":
        return _block_form(rows, codes, keys, extra_max)
    raise ValueError(f"unknown form {form!r}")


def grouped(rows: DataFrame, *keys: str) -> GroupedData:
    """Rows grouped by ``keys``, for an aggregate over strings.

    Spark sorts rows for such aggregates.  Led by a hash of all keys, most
    comparisons are of two numbers instead of several strings.
    """
    return rows.groupBy(F.xxhash64(*keys).alias("_sort"), *keys)


def _grouped_for(rows: DataFrame, *keys: str) -> GroupedData:
    # Maxima of numbers are kept in a hash table, which needs no such help.
    text = isinstance(rows.schema["_cell"].dataType, T.StringType)
    return grouped(rows, *keys) if text else rows.groupBy(*keys)


def _case_form(rows, codes, keys, extra_max) -> DataFrame:
    # Columns as text: building thousands of Column objects takes the driver seconds.
    columns = [
        F.expr(f"max(CASE WHEN _item = {text_literal(c)} THEN _cell END) AS {quoted(c)}")
        for c in codes
    ]
    extras = [F.max(c).alias(c) for c in extra_max]
    if not extras and not columns:
        return rows.select(*keys).distinct()
    return _grouped_for(rows, *keys).agg(*extras, *columns).drop("_sort")


def _block_form(rows, codes, keys, extra_max) -> DataFrame:
    spark = rows.sparkSession
    width = len(codes)
    # At most spark.sql.pivotMaxValues rows of (code, position): safe to broadcast.
    if width > max_columns(spark):
        raise PivotError(f"{width} item codes, the limit is {max_columns(spark)}")
    slots = spark.createDataFrame(
        [(code, slot) for slot, code in enumerate(codes)], "_item string, _slot int"
    )
    # NULL and unlisted codes share the NULL slot, which only keeps the filing.
    slotted = rows.join(F.broadcast(slots), "_item", "left").withColumn("_sort", F.xxhash64(*keys))
    # Both steps sort, led by the hash; the slot next tells most rows of one filing apart.
    cells = slotted.groupBy("_sort", "_slot", *keys).agg(
        F.max("_cell").alias("_cell"), *[F.max(c).alias(c) for c in extra_max]
    )
    # The cells of a filing in the order of their slots, NULLs in the gaps: a column looks at
    # its own place, so the work per filing does not grow with the square of the width.
    kind = cells.schema["_cell"].dataType.simpleString()
    filled = F.when(F.col("_slot").isNotNull() & F.col("_cell").isNotNull(), F.struct("_slot", "_cell"))
    filings = cells.groupBy("_sort", *keys).agg(
        *[F.max(c).alias(c) for c in extra_max], F.collect_list(filled).alias("_cells")
    )
    kept = [quoted(c) for c in (*keys, *extra_max)]
    # Slots of one filing are distinct, so cells of any type sort by them alone.
    in_order = filings.selectExpr(*kept, "array_sort(_cells, (a, b) -> a._slot - b._slot) AS _cells")
    # Places are kept by blocks of columns, and a block without a cell is one NULL: most filings
    # fill few blocks, and the places of the others are not made.
    block = f"c._slot div {BLOCK_COLUMNS}"
    starts = in_order.selectExpr(
        *kept,
        "_cells",
        f"filter(transform(_cells, (c, n) -> if({block} = get(_cells, n - 1)._slot div {BLOCK_COLUMNS}, null, n)),"
        " n -> n IS NOT NULL) AS _starts",
    )
    of_block = "slice(_cells, _starts[b] + 1, coalesce(get(_starts, b + 1), size(_cells)) - _starts[b])"
    places = (
        f"flatten(transform({of_block}, (c, n) -> concat(array_repeat(cast(null AS {kind}),"
        f" if(n = 0, c._slot % {BLOCK_COLUMNS}, c._slot - _cells[s + n - 1]._slot - 1)), array(c._cell))))"
    )
    before = f"coalesce(get(_cells, s - 1)._slot div {BLOCK_COLUMNS}, -1)"
    blocks = starts.selectExpr(
        *kept,
        f"flatten(transform(_starts, (s, b) -> concat(array_repeat(cast(null AS array<{kind}>),"
        f" cast(_cells[s]._slot div {BLOCK_COLUMNS} - {before} - 1 AS int)), array({places})))) AS _blocks",
    )
    return blocks.selectExpr(
        *kept,
        *[
            f"get(get(_blocks, {slot // BLOCK_COLUMNS}), {slot % BLOCK_COLUMNS}) AS {quoted(code)}"
            for slot, code in enumerate(codes)
        ],
    )


def _codes(narrow: DataFrame, item: str, items: Sequence[str] | None) -> list[str]:
    return list(items) if items is not None else discover_codes(narrow, item)


def _one_series(narrow: DataFrame, roles: Roles, series: str | None) -> DataFrame:
    return narrow if series is None else narrow.where(F.col(roles.series) == series)


def pivot_encoded(
    narrow: DataFrame,
    series: str | None = None,
    *,
    roles: Roles = COLLECTIONS,
    items: Sequence[str] | None = None,
    extra_keys: Sequence[str] = (),
    form: str = "auto",
) -> DataFrame:
    """Cells that carry up to three levels of context and the item value.

    The largest cell is the largest string: of 9 and 10 it is 9.
    """
    rows = _one_series(narrow, roles, series)
    return pivot(
        rows,
        encode_cell(roles),
        _codes(rows, roles.item, items),
        keys=[*roles.keys, *extra_keys],
        item=roles.item,
        form=form,
    )


def pivot_items(
    narrow: DataFrame,
    series: str | None = None,
    *,
    roles: Roles = COLLECTIONS,
    items: Sequence[str] | None = None,
    form: str = "auto",
) -> DataFrame:
    """Item values only, in their own type."""
    rows = _one_series(narrow, roles, series)
    return pivot(
        rows,
        F.col(roles.value),
        _codes(rows, roles.item, items),
        keys=roles.keys,
        item=roles.item,
        form=form,
    )


def pivot_kv(
    narrow: DataFrame,
    series: str | None = None,
    *,
    roles: Roles = KV,
    items: Sequence[str] | None = None,
    form: str = "auto",
) -> DataFrame:
    """Key/value rows; numeric values have a numeric maximum."""
    return pivot_items(narrow, series, roles=roles, items=items, form=form)


def pivot_items_with_context(
    narrow: DataFrame,
    series: str | None = None,
    *,
    roles: Roles = COLLECTIONS,
    items: Sequence[str] | None = None,
    level: int = 1,
    form: str = "auto",
) -> DataFrame:
    """Item values, and the largest code, text and value of one context level.

    The three maxima are independent of each other and may come from three rows.
    """
    rows = _one_series(narrow, roles, series)
    context = roles.contexts[level - 1]
    return pivot(
        rows,
        F.col(roles.value),
        _codes(rows, roles.item, items),
        keys=roles.keys,
        item=roles.item,
        extra_max=[c for c in (context.code, context.desc, context.value) if c],
        form=form,
    )


def composite_code(roles: Roles = COLLECTIONS, level: int = 1) -> Column:
    """``<item>_CTX<value>``, or the bare item where there is no context value."""
    item, value = F.col(roles.item), F.col(roles.contexts[level - 1].value).cast("string")
    return F.when(F.coalesce(value, F.lit("")) == "", item).otherwise(
        F.concat(item, F.lit("_CTX"), value)
    )


def pivot_composite(
    narrow: DataFrame,
    series: str | None = None,
    *,
    roles: Roles = COLLECTIONS,
    items: Sequence[str] | None = None,
    level: int = 1,
    form: str = "auto",
) -> DataFrame:
    """One column per (item, context value)."""
    rows = _one_series(narrow, roles, series).withColumn("_code", composite_code(roles, level))
    return pivot(
        rows,
        F.col(roles.value),
        _codes(rows, "_code", items),
        keys=roles.keys,
        item="_code",
        form=form,
    )


def pivot_api(
    narrow: DataFrame,
    series: str | None = None,
    *,
    roles: Roles = KV,
    items: Sequence[str] | None = None,
) -> DataFrame:
    """The same relation through Spark's own pivot.

    For fixed-width values Spark plans it as maximum per (filing, key) followed
    by one pass that places the maxima, so its cost does not grow with the width.
    """
    rows = _one_series(narrow, roles, series)
    codes = _codes(rows, roles.item, items)
    check_columns(codes, roles.keys)
    return rows.groupBy(*roles.keys).pivot(roles.item, codes).agg(F.max(roles.value))


def code_groups(codes: Sequence[str], prefix_length: int = 4) -> dict[str, list[str]]:
    """Codes by their leading part."""
    groups: dict[str, list[str]] = {}
    for code in codes:
        groups.setdefault(code[:prefix_length], []).append(code)
    return groups


def pivot_by_group(
    narrow: DataFrame,
    series: str | None = None,
    *,
    roles: Roles = COLLECTIONS,
    prefix_length: int = 4,
    form: str = "auto",
) -> tuple[DataFrame, dict[str, list[str]]]:
    """A wide series in one pivot, and its columns by the leading part of the code.

    A relation of one group is a selection of the keys and the group's columns.
    """
    rows = _one_series(narrow, roles, series)
    codes = discover_codes(rows, roles.item)
    wide = pivot_encoded(rows, roles=roles, items=codes, form=form)
    return wide, code_groups(codes, prefix_length)


def pivot_custom(
    narrow: DataFrame,
    cell: Column,
    *,
    keys: Sequence[str],
    item: str | Column,
    items: Sequence[str],
    where: Column | None = None,
    extra_columns: Mapping[str, Column] | None = None,
    form: str = "auto",
) -> DataFrame:
    """A pivot with the caller's keys, row filter and added columns."""
    rows = narrow if where is None else narrow.where(where)
    wide = pivot(rows, cell, items, keys=keys, item=item, form=form)
    return wide.withColumns(dict(extra_columns)) if extra_columns else wide


def unpivot(wide: DataFrame, keys: Sequence[str], *, item: str, value: str) -> DataFrame:
    """Wide back to narrow: one row per filled cell."""
    columns = [c for c in wide.columns if c not in set(keys)]
    return wide.unpivot(
        [quoted(k) for k in keys], [quoted(c) for c in columns], item, value
    ).where(F.col(value).isNotNull())
