"""Cells of a wide table: an item value with its context folded in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from narrowlake.model import COLLECTIONS, Roles

# Documented patterns for value, level-1 code and level-1 value.
CELL_VALUE = ":([0-9]+)$"
CELL_CODE = "^([^=]+)="
CELL_CONTEXT = "^[^=]+=([^:]+)"

MAX_LEVELS = 3


def quoted(name: str) -> str:
    """A column or table name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """A string as SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def encode_cell_sql(roles: Roles = COLLECTIONS) -> str:
    """SQL text of the cell of one narrow row.

    ``code=value`` of each level that has a code, then the item value, joined by
    colons.  Levels count only when the first one has a code; a missing context
    value is written as nothing; a missing item value makes the cell NULL.  The
    text serves stored views and, through ``expr``, DataFrames.
    """
    value = f"cast({quoted(roles.value)} as string)"
    if not roles.contexts:
        return value
    levels = []
    for level in roles.contexts:
        code = f"nullif(cast({quoted(level.code)} as string), '')"
        text = f"coalesce(cast({quoted(level.value)} as string), '')"
        levels.append(f"concat({code}, '=', {text})")
    first = f"nullif(cast({quoted(roles.contexts[0].code)} as string), '')"
    return (
        f"if({first} is null, {value}, "
        f"concat(concat_ws(':', {', '.join(levels)}), ':', {value}))"
    )


def encode_cell(roles: Roles = COLLECTIONS) -> Column:
    return F.expr(encode_cell_sql(roles))


def decode_regex(cell: Column | str, prefix: str) -> list[Column]:
    """Value, level-1 code and level-1 value by the documented patterns.

    As documented, a part that does not match comes back as an empty string: a
    cell without context, a negative or a decimal value gives no value.
    """
    cell = F.col(cell) if isinstance(cell, str) else cell
    return [
        F.regexp_extract(cell, CELL_VALUE, 1).alias(f"{prefix}_value"),
        F.regexp_extract(cell, CELL_CODE, 1).alias(f"{prefix}_context1_mdrm"),
        F.regexp_extract(cell, CELL_CONTEXT, 1).alias(f"{prefix}_context1_value"),
    ]


def decode_cell(cell: Column | str, prefix: str, levels: int = MAX_LEVELS) -> list[Column]:
    """All parts of a cell, for any kind of value.

    The last part is the value, the parts before it are ``code=value`` pairs in
    cell order; absent ones are NULL.  A cell whose value itself holds a colon
    can not be told apart from one with more context.
    """
    cell = F.col(cell) if isinstance(cell, str) else cell
    parts = F.split(cell, ":", -1)
    out = [F.element_at(parts, -1).alias(f"{prefix}_value")]
    for n in range(levels):
        part = F.when(F.size(parts) > n + 1, F.get(parts, F.lit(n)))
        split_at = F.instr(part, "=")
        out.append(part.substr(F.lit(1), split_at - 1).alias(f"{prefix}_context{n + 1}_mdrm"))
        out.append(
            part.substr(split_at + 1, F.length(part)).alias(f"{prefix}_context{n + 1}_value")
        )
    return out
