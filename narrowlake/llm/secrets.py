"""Secrets in texts: fixed rules, and character Markov models of random and ordinary strings."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import table
from narrowlake.llm.spans import SPAN, highest, let, matches, nothing, running

# The base rules; a match counts when its part has so many characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_PART = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]

# Characters the Markov models know; any other ends a candidate.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
_IN = r"A-Za-z0-9+/_\-"
# Candidates are all whole runs of at least so many characters; shorter ones say too little.
LEAST = 8
CANDIDATE = rf"[{_IN}]{{{LEAST},}}+"
# Ordinary identifiers: whole runs of letters, dashes and underscores.
ORDINARY = rf"(?<![{_IN}])[A-Za-z_\-]{{8,}}+(?![{_IN}])"
# Documents whose identifiers are learned, about; every base match of the table is learned.
SAMPLE_DOCUMENTS = 20_000
# Least mean log-likelihood ratio of a character, in nats, of runs of FULL characters or more;
# the means of shorter runs vary more and need more, by the root of their number of pairs.
THRESHOLD = 0.9
FULL = 16
# Characters of the chunks that a text is cut into to take parts of it.
CHUNK = 4096


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base rule.  Texts that can not match are not searched."""
    keyword = text.rlike("(?i)password|passwd|secret|token|api_?key")
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["part"]) >= ASSIGN_PART)
    return {
        "assign": F.when(keyword, assign).otherwise(nothing()),
        "access": F.when(text.contains("AKIA"), matches(text, ACCESS)).otherwise(nothing()),
        "hex": F.when(text.rlike(HEX), matches(text, HEX)).otherwise(nothing()),
    }


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs, random against ordinary, row by row.

    The labelled samples are the parts that base rules find in any document (random) and
    the identifiers of about SAMPLE_DOCUMENTS documents chosen by a hash of the text
    (ordinary).  Pair counts with one added to each come to the driver: one number for each
    pair of the alphabet, whatever the size of the table.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64(F.lit(5), text), F.lit(1 << 30).cast("long")) < int(share * (1 << 30)) + 1
    spans = base_spans(text)
    rows = docs.select(
        F.flatten(F.array(*[F.transform(s, lambda m: m["part"]) for s in spans.values()])).alias("random"),
        F.when(chosen, F.regexp_extract_all(text, F.lit(ORDINARY), F.lit(0)))
        .otherwise(F.array().cast("array<string>"))
        .alias("ordinary"),
    )
    words = rows.select(
        F.explode(
            F.concat(
                F.transform("random", lambda w: F.struct(F.lit(1).alias("kind"), w.alias("word"))),
                F.transform("ordinary", lambda w: F.struct(F.lit(0).alias("kind"), w.alias("word"))),
            )
        ).alias("w")
    ).select("w.*")
    # Equal words are counted before their characters are looked at.
    words = words.groupBy("kind", "word").count()
    pairs = words.select(
        "kind",
        "count",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr(F.col("word"), i, F.lit(2))
            )
        ).alias("pair"),
    ).where(F.length("word") > 1)
    counts = {(r["kind"], r["pair"]): r["n"] for r in pairs.groupBy("kind", "pair").agg(F.sum("count").alias("n")).collect()}
    chances = []
    for kind in (1, 0):
        table_of = [[1 + counts.get((kind, a + b), 0) for b in ALPHABET] for a in ALPHABET]
        chances.append([math.log(n / sum(row)) for row in table_of for n in row])
    return [a - b for a, b in zip(*chances)]


def ratio(word: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of the pairs of a word's characters."""
    table_of = F.from_json(F.lit(json.dumps(model)), "array<double>")
    places = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(
        F.slice(places, F.lit(1), F.size(places) - 1),
        F.slice(places, F.lit(2), F.size(places) - 1),
        lambda a, b: F.get(table_of, (a - 1) * len(ALPHABET) + b - 1),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x) / F.size(pairs)


def random_spans(text: Column, model: list[float]) -> Column:
    """Spans of the candidates that are more likely random than ordinary.

    Only these take part in the sums of places, which stay linear in the number of words.
    """
    least = lambda h: THRESHOLD * F.sqrt(F.greatest(F.lit(1.0), (FULL - 1) / (F.length(h) - 1)))
    hits = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    gaps = F.transform(F.split(text, CANDIDATE, -1), F.length)

    def placed(hits: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: g + F.length(h))
        found = F.filter(
            F.arrays_zip(running(sizes).alias("end"), hits.alias("hit")), lambda m: ratio(m["hit"], model) >= least(m["hit"])
        )
        return F.transform(
            found,
            lambda m: F.struct(
                (m["end"] - F.length(m["hit"])).alias("start"), m["end"].alias("end"), m["hit"].alias("hit"), m["hit"].alias("part")
            ),
        ).cast(SPAN)

    return let(hits, placed)


def _unused(names: list[str], name: str) -> str:
    while name.lower() in {n.lower() for n in names}:
        name += "_"
    return name


def find(docs: DataFrame, model: list[float], column: str = "secret_spans") -> DataFrame:
    """The documents with secret_spans: (start, kind, end) of all spans, by start and kind.

    kind is a place in KINDS.  The models judge every whole run of LEAST or more characters
    of the alphabet, letters or digits alone too; shorter runs are not looked at.  Spans of the
    Markov models that spans of base rules cover wholly, alone or together, are left out;
    base spans all stay.

    Null, empty and blank texts have none; equal rows have equal spans; an empty table gives
    an empty result.  The work grows with the length of a text times the root of the number
    of its spans.  An existing column of the name is replaced, others stay.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    held = _unused(docs.columns, "secret_held")
    docs = docs.withColumn(held, F.struct(*[s.alias(k) for k, s in base_spans(text).items()]))
    kinds = {k: F.col(held)[k] for k in KINDS[:-1]}
    random = F.when(text.rlike(CANDIDATE), _apart(random_spans(text, model), F.concat(*kinds.values()))).otherwise(nothing())
    marked = [_marked(spans, place) for place, spans in enumerate([*kinds.values(), random])]
    return docs.withColumn(column, F.array_sort(F.concat(*marked))).drop(held)


def _apart(spans: Column, base: Column) -> Column:
    """The spans that base spans do not cover wholly.

    Base spans that touch are joined; then the last joined one that starts no later than a
    span is the only one that can cover it, so one pass over all by start is enough.
    """
    kind = "array<struct<start:bigint,kind:int,end:bigint,hit:string,part:string>>"

    def joined(sorted_base: Column) -> Column:
        tops = highest(F.transform(sorted_base, lambda b: b["end"]))
        before = F.concat(F.array(F.lit(-1).cast("bigint")), F.slice(tops, F.lit(1), F.size(tops) - 1))
        rows = F.arrays_zip(F.transform(sorted_base, lambda b: b["start"]).alias("start"), before.alias("before"))
        firsts = F.filter(rows, lambda r: r["start"] > r["before"])
        ends = F.concat(
            F.slice(F.transform(firsts, lambda r: r["before"]), F.lit(2), F.size(firsts) - 1), F.array(F.element_at(tops, -1))
        )
        return F.zip_with(
            firsts,
            ends,
            lambda r, end: F.struct(
                r["start"].alias("start"), F.lit(0).alias("kind"), end.alias("end"), F.lit("").alias("hit"), F.lit("").alias("part")
            ),
        ).cast(kind)

    own = F.transform(
        spans, lambda m: F.struct(m["start"].alias("start"), F.lit(1).alias("kind"), m["end"].alias("end"), m["hit"], m["part"])
    ).cast(kind)
    covers = let(F.array_sort(base), lambda b: F.when(F.size(b) > 0, joined(b)).otherwise(F.array().cast(kind)))

    def left(rows: Column) -> Column:
        tops = highest(F.transform(rows, lambda r: F.when(r["kind"] == 0, r["end"]).otherwise(F.lit(0).cast("bigint"))))
        free = F.filter(F.arrays_zip(rows.alias("row"), tops.alias("top")), lambda z: (z["row"]["kind"] == 1) & (z["top"] < z["row"]["end"]))
        return F.transform(
            free, lambda z: F.struct(z["row"]["start"], z["row"]["end"], z["row"]["hit"], z["row"]["part"])
        ).cast(SPAN)

    return let(F.array_sort(F.concat(covers, own)), left)


def _marked(spans: Column, kind: int) -> Column:
    return F.transform(
        spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    )


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _piece(chunks: Column, start: Column, end: Column) -> Column:
    """The text from start to before end, of a text that is cut into chunks of CHUNK characters."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")
    at = (start % CHUNK + 1).cast("int")
    head = F.get(chunks, first)
    several = F.concat(
        F.substr(head, at),
        F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substr(F.get(chunks, last), F.lit(1), (end - last * CHUNK).cast("int")),
    )
    return F.when(start >= end, F.lit("")).when(first == last, F.substr(head, at, (end - start).cast("int"))).otherwise(several)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with a mark in place of each run of overlapping spans, which are in order of their starts.

    The text is cut once; no part of it is looked for from its beginning again.
    """

    def made(chunks: Column) -> Column:
        def marked(tops: Column) -> Column:
            before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(tops, F.lit(1), F.size(tops) - 1))
            rows = F.arrays_zip(F.transform(spans, lambda s: s["start"]).alias("start"), before.alias("at"))
            parts = F.transform(
                rows,
                lambda r: F.when(r["start"] < r["at"], F.lit("")).otherwise(
                    F.concat(_piece(chunks, r["at"], r["start"]), F.lit(mark))
                ),
            )
            return F.concat(F.array_join(parts, ""), _piece(chunks, F.element_at(tops, -1), F.length(text).cast("bigint")))

        return let(highest(F.transform(spans, lambda s: s["end"])), marked)

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(let(cut, made))


def clean(docs: DataFrame, model: list[float]) -> DataFrame:
    """The documents with their secrets replaced by a mark; other texts stay as they are.

    Null texts stay null, and n_chars, where there is one, follows a text that changes.  Other
    columns stay whatever their names; equal rows stay equal.
    """
    names = docs.columns
    column = _unused(names, "secret_spans")
    text, spans = F.coalesce(F.col("text"), F.lit("")), F.col(column)
    found = find(docs, model, column).withColumn("text", F.when(F.col("text").isNotNull(), redacted(text, spans)))
    if "n_chars" in names:
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*names)


def digests(docs: DataFrame, model: list[float]) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""

    def told(spans: Column) -> Column:
        kinds = F.array(*map(F.lit, KINDS))
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
        )

    found = find(docs.select("doc_id", "text"), model)
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"] < KINDS.index("markov"))
    counts = [_count(spans, place).alias(f"n_{kind}") for place, kind in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(spans).alias("spans"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digests(docs, train(docs))
