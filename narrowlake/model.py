"""Column roles of the narrow tables.

One builder serves all three generations of the narrow schema; what differs is
which column plays which role.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Series accepted by the loader and the wide publisher.
SERIES_PREFIXES = ("FRY9C", "FRY15", "FR2004A")

# Fixed value: ingest time of a file whose path names none.
UNKNOWN_INGEST = "unknown"


@dataclass(frozen=True)
class Context:
    """One level of context that qualifies an item."""

    code: str
    value: str
    desc: str | None = None


@dataclass(frozen=True)
class Roles:
    series: str
    keys: tuple[str, ...]
    item: str
    value: str
    submission: str | None = None
    entity: str | None = None
    as_of: str | None = None
    ingest: str = "ingest_timestamp"
    desc: str | None = None
    contexts: tuple[Context, ...] = ()

    @property
    def filing_keys(self) -> tuple[str, ...]:
        """The keys of a filing irrespective of its submission."""
        return tuple(k for k in self.keys if k != self.submission)

    @property
    def logical_key(self) -> tuple[str, ...]:
        return (*self.keys, self.item, self.ingest)

    @property
    def desc_columns(self) -> tuple[str, ...]:
        return tuple(c for c in (self.desc, *(x.desc for x in self.contexts)) if c)

    @property
    def columns(self) -> tuple[str, ...]:
        """Columns of a raw drop, in file order."""
        out = [*self.keys, self.item]
        if self.desc:
            out.append(self.desc)
        out.append(self.value)
        for level in self.contexts:
            out += [c for c in (level.code, level.desc, level.value) if c]
        return tuple(out)

    def csv_schema(self) -> T.StructType:
        """All-string schema: one odd row can not change the type of a column."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def with_keys(self, *keys: str) -> Roles:
        return replace(self, keys=keys)


# Column names of the three narrow schemas.
COLLECTIONS = Roles(
    series="seriesid",
    keys=("seriesid", "aod", "rssdid", "submission_ts"),
    item="item_mdrm",
    desc="item_desc",
    value="item_value",
    submission="submission_ts",
    entity="rssdid",
    as_of="aod",
    contexts=tuple(
        Context(
            code=f"context_level{n}_mdrm",
            desc=f"context_level{n}_desc",
            value=f"context_level{n}_value",
        )
        for n in (1, 2, 3)
    ),
)

KV = Roles(
    series="seriesid",
    keys=("seriesid", "aod", "rssdid", "submissionts"),
    item="key",
    value="value",
    submission="submissionts",
    entity="rssdid",
    as_of="aod",
)

ENTITY = Roles(
    series="entity1",
    keys=("entity1", "entity2", "entity3", "entity4"),
    item="key",
    value="value",
)
