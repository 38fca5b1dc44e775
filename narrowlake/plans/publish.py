"""Published relations: plain views, pivoted views, stored wide tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from narrowlake.functions.cells import encode_cell_sql, quoted, text_literal
from narrowlake.model import COLLECTIONS, KV, SERIES_PREFIXES, UNKNOWN_INGEST, Roles
from narrowlake.operators.filters import series_is_valid
from narrowlake.operators.pivots import check_columns, discover_codes, pivot_encoded, pivot_kv
from narrowlake.operators.quality import all_string_columns
from narrowlake.session import PARALLEL_JOBS
from narrowlake.sinks.tables import replace_wide_table, table_name

# Names of the plain views, unless the caller gives others.
ALL_ROWS_VIEW = "collections_data_vw"
ONE_SERIES_VIEW = "one_series_vw"

# A relation is a view, which follows its table, or a table, which is a state of it.
# Which one is the caller's choice, never that of a size.
KINDS = ("view", "table")

STATUS_SCHEMA = (
    "name string, series string, kind string, n_columns int, status string, error string"
)
CHECK_SCHEMA = "view string, check string, passed boolean, detail string"


class NameCollision(ValueError):
    """Two series would be published under one name."""


def wide_view_name(series: str) -> str:
    return f"{series.lower()}_wide_view"


def report_view_name(series: str) -> str:
    return f"{series}_report_view"


def prefixed_name(prefix: str) -> Callable[[str], str]:
    return lambda series: f"{prefix}_{series}"


def _qualified(database: str | None, name: str) -> str:
    return f"{database}.{name}" if database else name


def drop_relation(spark: SparkSession, name: str) -> None:
    """Drop a view or table of this name if there is one."""
    if not spark.catalog.tableExists(name):
        return
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    spark.sql(f"DROP {kind} IF EXISTS {table_name(name)}")


def create_view(spark: SparkSession, name: str, body: str) -> None:
    """Create the view in place of any earlier one; a stored table of its name goes first."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(body).schema  # a body that can not be analysed leaves the table alone
        drop_relation(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {table_name(name)} AS {body}")


def list_views(spark: SparkSession, database: str | None = None, like: str = "*") -> DataFrame:
    """Names of views by pattern."""
    where = f" IN {table_name(database)}" if database else ""
    return spark.sql(f"SHOW VIEWS{where} LIKE {text_literal(like)}").select(
        F.col("viewName").alias("view_name")
    )


def list_relations(spark: SparkSession, database: str | None = None, like: str = "*") -> DataFrame:
    """Names of views and stored tables by pattern."""
    where = f" IN {table_name(database)}" if database else ""
    return spark.sql(f"SHOW TABLES{where} LIKE {text_literal(like)}").where("NOT isTemporary").select(
        F.col("tableName").alias("name")
    )


def drop_views(spark: SparkSession, prefix: str, database: str | None = None) -> list[str]:
    """Drop all views whose name starts with ``prefix``."""
    names = sorted(r[0] for r in list_views(spark, database, prefix + "*").collect())
    for name in names:
        spark.sql(f"DROP VIEW IF EXISTS {table_name(_qualified(database, name))}")
    return names


def publish_normal(
    spark: SparkSession,
    table: str,
    series: str,
    *,
    database: str | None = None,
    roles: Roles = COLLECTIONS,
    all_rows_name: str = ALL_ROWS_VIEW,
    one_series_name: str = ONE_SERIES_VIEW,
) -> DataFrame:
    """The view of all rows, and the view of one series by exact name."""
    source = f"SELECT * FROM {table_name(table)}"
    bodies = {
        all_rows_name: ("", source),
        one_series_name: (
            series,
            f"{source} WHERE {quoted(roles.series)} = {text_literal(series)}",
        ),
    }
    status = []
    for name, (of, body) in bodies.items():
        full = _qualified(database, name)
        made = _attempt(spark, full, of, "view", lambda n=full, b=body: _view(spark, n, b))
        status.append(made)
    return spark.createDataFrame(status, STATUS_SCHEMA)


def _view(spark: SparkSession, name: str, body: str) -> tuple[str, int]:
    create_view(spark, name, body)
    return "view", len(spark.table(name).columns)


def _attempt(
    spark: SparkSession, name: str, series: str, kind: str, make: Callable[[], tuple[str, int]]
) -> tuple:
    """One row of the status relation; a failure does not stop the others."""
    try:
        kind, width = make()
        return (name, series, kind, width, "created", None)
    except Exception as error:  # noqa: BLE001 - reported, not hidden
        return (name, series, kind, None, "failed", str(error).splitlines()[0])


def publish_latest(
    spark: SparkSession, table: str, view: str, roles: Roles = COLLECTIONS
) -> None:
    """The view of the current state: latest submission of every (filing, item)."""
    columns = spark.table(table).columns
    keys = [*roles.filing_keys, roles.item]
    order = [roles.submission, roles.ingest, roles.value]
    row = [*order, *(c for c in columns if c not in {*keys, *order})]
    grouped_by = ", ".join(quoted(k) for k in keys)
    fields = ", ".join(quoted(c) for c in row)
    out = ", ".join(quoted(c) if c in keys else f"_row.{quoted(c)}" for c in columns)
    create_view(
        spark,
        view,
        f"SELECT {out} FROM (SELECT {grouped_by}, max(struct({fields})) AS _row "
        f"FROM {table_name(table)} GROUP BY {grouped_by})",
    )


def publish_as_of(
    spark: SparkSession, table: str, view: str, ingest: str, roles: Roles = COLLECTIONS
) -> None:
    """The view of the table as it stood after an ingest."""
    create_view(
        spark,
        view,
        f"SELECT * FROM {table_name(table)} WHERE {as_of_sql(quoted(roles.ingest), ingest)}",
    )


def as_of_sql(ingest: str, bound: str) -> str:
    """Ingest times up to a bound, as numbers if both are, else as text."""
    at = text_literal(bound)
    number = f"try_cast({ingest} AS DECIMAL(38, 0)) <= try_cast({at} AS DECIMAL(38, 0))"
    return f"coalesce({number}, {ingest} <= {at}) AND {ingest} <> {text_literal(UNKNOWN_INGEST)}"


def pivot_view_sql(
    table: str, series: str, codes: Sequence[str], cell_sql: str, roles: Roles = COLLECTIONS
) -> str:
    """Text of the pivoted view of one series."""
    keys = ", ".join(quoted(k) for k in roles.keys)
    columns = ", ".join(f"{text_literal(c)} AS {quoted(c)}" for c in codes)
    return (
        f"SELECT * FROM (SELECT {keys}, {quoted(roles.item)} AS _item, {cell_sql} AS _cell "
        f"FROM {table_name(table)} WHERE {quoted(roles.series)} = {text_literal(series)}) "
        f"PIVOT (max(_cell) FOR _item IN ({columns}))"
    )


def names_of(series: Sequence[str], name_fn: Callable[[str], str]) -> dict[str, str]:
    """Series to relation name; names are compared as the catalog does, without case."""
    names: dict[str, str] = {}
    taken: dict[str, str] = {}
    for s in series:
        name = name_fn(s)
        other = taken.setdefault(name.lower(), s)
        if other != s:
            raise NameCollision(f"series {other!r} and {s!r} would both be published as {name!r}")
        names[s] = name
    return names


def _publish(
    spark: SparkSession,
    table: str,
    *,
    roles: Roles,
    prefixes: Sequence[str] | None,
    name_fn: Callable[[str], str],
    cell_sql: str,
    build: Callable[..., DataFrame],
    database: str | None,
    kind: str | Mapping[str, str],
    location: str | None,
    codes: DataFrame | None = None,
) -> DataFrame:
    kinds = {kind} if isinstance(kind, str) else set(kind.values())
    if not kinds <= set(KINDS):
        raise ValueError(f"unknown kind {sorted(kinds - set(KINDS))}")
    source = spark.table(table)
    known = source if codes is None else codes
    chosen = known if prefixes is None else known.where(series_is_valid(roles.series, prefixes))
    series_found = [r[0] for r in chosen.select(roles.series).distinct().collect()]
    found = sorted(s for s in series_found if s is not None)
    names = names_of(found, name_fn)

    def make(series: str) -> tuple[str, int]:
        # Codes of one series at a time: the limit on columns bounds what is fetched.
        name = _qualified(database, names[series])
        items = discover_codes(chosen.where(F.col(roles.series) == series), roles.item)
        check_columns(items, roles.keys)
        of = kind if isinstance(kind, str) else kind.get(series, "view")
        if of == "view":
            keys = ", ".join(quoted(k) for k in roles.keys)
            bare = (
                f"SELECT DISTINCT {keys} FROM {table_name(table)} "
                f"WHERE {quoted(roles.series)} = {text_literal(series)}"
            )
            body = pivot_view_sql(table, series, items, cell_sql, roles) if items else bare
            return _view(spark, name, body)
        wide = build(source, series, roles=roles, items=items)
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW":
            drop_relation(spark, name)
        path = f"{location.rstrip('/')}/{names[series]}" if location else None
        replace_wide_table(wide, name, partition_by=[roles.as_of] if roles.as_of else (), path=path)
        return "table", len(wide.columns)

    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        status = list(
            pool.map(
                lambda s: _attempt(spark, _qualified(database, names[s]), s, "view", lambda: make(s)),
                found,
            )
        )
    report = spark.createDataFrame(status, STATUS_SCHEMA)
    if prefixes is None:
        return report
    # Any number of other series may be in the table, so they stay a query.
    none = F.lit(None).cast("string")
    skipped = (
        known.where(~series_is_valid(roles.series, prefixes))
        .select(F.col(roles.series).alias("series"))
        .distinct()
        .select(
            none.alias("name"),
            "series",
            none.alias("kind"),
            F.lit(None).cast("int").alias("n_columns"),
            F.lit("skipped").alias("status"),
            F.lit("series is not published").alias("error"),
        )
    )
    return report.unionByName(skipped)


def publish_wide(
    spark: SparkSession,
    table: str,
    *,
    roles: Roles = COLLECTIONS,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    database: str | None = None,
    kind: str | Mapping[str, str] = "view",
    location: str | None = None,
    name_fn: Callable[[str], str] = wide_view_name,
    codes: DataFrame | None = None,
) -> DataFrame:
    """One relation per accepted series with encoded cells.

    ``codes`` are the series and item codes as ``derived.merge_codes`` keeps them; without
    them they are looked for in the whole table.

    ``kind`` is that of all relations, or of some by series: a view, which follows the
    table whatever its width, or a table, stored by as-of date and written anew.  Returns
    what was created, failed and skipped; rows without a series, or with a blank one that
    partitioned files hold as none, are one skipped row.
    """
    return _publish(
        spark,
        table,
        roles=roles,
        prefixes=prefixes,
        name_fn=name_fn,
        cell_sql=encode_cell_sql(roles),
        build=pivot_encoded,
        database=database,
        kind=kind,
        location=location,
        codes=codes,
    )


def publish_report(
    spark: SparkSession,
    table: str,
    *,
    roles: Roles = KV,
    database: str | None = None,
    name_fn: Callable[[str], str] = report_view_name,
    kind: str | Mapping[str, str] = "view",
    location: str | None = None,
) -> DataFrame:
    """One key/value pivot per series, values in their own type."""
    return _publish(
        spark,
        table,
        roles=roles,
        prefixes=None,
        name_fn=name_fn,
        cell_sql=quoted(roles.value),
        build=pivot_kv,
        database=database,
        kind=kind,
        location=location,
    )


def materialise_wide(
    spark: SparkSession,
    table: str,
    prefix: str,
    *,
    roles: Roles = KV,
    database: str | None = None,
    location: str | None = None,
) -> DataFrame:
    """One stored table per series, whatever its width."""
    return publish_report(
        spark,
        table,
        roles=roles,
        database=database,
        name_fn=prefixed_name(prefix),
        kind="table",
        location=location,
    )


def check_views(
    spark: SparkSession,
    source_table: str,
    *,
    like: str = "*",
    database: str | None = None,
    roles: Roles = COLLECTIONS,
) -> DataFrame:
    """Checks of every relation, view or table: schema, rows, sample, grouping, columns,
    join to the source.  Rows, sample, groups and columns come from one aggregation of
    the keys and the first items, the join from one comparison of keys.
    """
    source = spark.table(source_table)
    keys = list(roles.keys)

    def checks(name: str) -> list[tuple]:
        view = spark.table(_qualified(database, name))
        items = [c for c in view.columns if c not in keys]
        few = items[:5]
        measured: list[Row] = []

        def found() -> Row:
            if not measured:
                by = (roles.series, roles.as_of or keys[1])
                filled = [F.count(F.col(quoted(c))).alias(f"_{n}") for n, c in enumerate(few)]
                grouped = view.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *filled)
                sums = [F.sum(f"_{n}").alias(f"_{n}") for n in range(len(few))]
                measured.append(
                    grouped.agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("groups"), *sums).first()
                )
            return measured[0]

        def schema():
            bad = all_string_columns(view)
            return not bad, f"{len(view.columns)} columns, not text: {bad}"

        def rows():
            n = found()["rows"] or 0
            return n > 0, f"{n} rows"

        def sample():
            n = min(5, found()["rows"] or 0)
            return n > 0, f"{n} rows"

        def group():
            n = found()["groups"]
            return n > 0, f"{n} groups"

        def columns():
            filled = sum(bool(found()[f"_{n}"]) for n in range(len(few)))
            return bool(few), f"{len(few)} item columns, {filled} with values"

        def joins():
            own = view.select(*keys, F.lit(1).alias("_in_view"), F.lit(0).alias("_in_source"))
            known = source.select(*keys, F.lit(0).alias("_in_view"), F.lit(1).alias("_in_source"))
            sides = own.unionByName(known).groupBy(*keys)
            sides = sides.agg(F.max("_in_view").alias("v"), F.max("_in_source").alias("s"))
            n = sides.where("v = 1 AND s = 0").count()
            return n == 0, f"{n} filings without a source row"

        out = []
        for check in (schema, rows, sample, group, columns, joins):
            try:
                passed, detail = check()
            except Exception as error:  # noqa: BLE001 - reported, not hidden
                passed, detail = False, str(error).splitlines()[0]
            out.append((name, check.__name__, passed, detail))
        return out

    names = sorted(r[0] for r in list_relations(spark, database, like).collect())
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        found = [row for rows in pool.map(checks, names) for row in rows]
    return spark.createDataFrame(found, CHECK_SCHEMA)
