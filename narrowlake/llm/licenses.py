"""Licence statements by ordered signature rules over the words of a text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import ascii_lower, table
from narrowlake.llm.spans import matches

# Words of a lower-cased text, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public names of licences as words: label, keyword that a text must hold, pattern of the name.
_FSF = r"(?: as published by the free software foundation)?(?: either)?"
NAMES = [
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("mit", "mit", r"mit(?:(?: x11)? licen[sc]e| x11)"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e"),
    ("gpl-2.0", "general public", rf"(?:gnu )?general public licen[sc]e{_FSF}(?: version| v)? ?2(?: 0)?"),
    ("gpl-3.0", "general public", rf"(?:gnu )?general public licen[sc]e{_FSF}(?: version| v)? ?3(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?(?:version |v)?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl ?(?:version |v)?3(?: 0)?"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("lgpl-2.0", "general public", rf"(?:gnu )?library general public licen[sc]e{_FSF}(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", "general public", rf"(?:gnu )?(?:lesser|library) general public licen[sc]e{_FSF}(?: version| v)? ?2 1"),
    ("lgpl-3.0", "general public", rf"(?:gnu )?lesser general public licen[sc]e{_FSF}(?: version| v)? ?3(?: 0)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?(?:version |v)?[23](?: [01])?)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public licen[sc]e{_FSF}(?: version| v)? ?3(?: 0)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl ?(?:version |v)?3(?: 0)?"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e(?: version| v)? ?1 [01]"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e(?:(?: version| v)? ?2(?: 0)?)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("cddl-1.0", "common development", r"common development and distribution licen[sc]e"),
    ("cpl-1.0", "common public", r"common public licen[sc]e"),
    ("eupl-1.2", "european union", r"european union public licen[sc]e"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("boost-1.0", "boost", r"boost software licen[sc]e"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[sc]e(?: [12] 0)?"),
    ("psf", "python software", r"python software foundation licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e"),
    ("odbl", "open database", r"open database licen[sc]e"),
    ("odc-by", "open data", r"open data commons attribution licen[sc]e"),
    ("ms-pl", "microsoft public", r"microsoft public licen[sc]e"),
    ("cc0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "creative commons", r"creative commons attribution(?: licen[sc]e)?(?: [1234] [05])?"),
    ("cc-by", "cc by", r"cc by(?: [1234] [05])?"),
    ("cc-by-sa", "cc by", r"cc by sa(?: [1234] [05])?"),
    ("cc-by-nc", "cc by", r"cc by nc(?: [1234] [05])?"),
    ("cc-by-nd", "cc by", r"cc by nd(?: [1234] [05])?"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd(?: [1234] [05])?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike(?: licen[sc]e)?(?: [1234] [05])?"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: licen[sc]e)?(?: [1234] [05])?"),
    ("public-domain", "public domain", r"(?:in|into) the public domain"),
    ("proprietary", "all rights", r"all rights reserved"),
]
# Sentences that the texts and notices of licences consist of: label, keyword, pattern.
TEXTS = [
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"),
    ("boost-1.0", "hereby granted", r"permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software and accompanying documentation"),
    ("isc", "with or without fee", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "source and binary", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "nor the names", r"neither the names? of (?:[^ ]+ ){1,12}?nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "mentioning features", r"all advertising materials mentioning features or use of this software must display"),
    ("zlib", "express or implied", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "want to public", r"do what the fuck you want to public licen[sc]e"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl-1.1", "contents of this file", r"the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("gpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("lgpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    ("agpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e"),
    ("apache-2.0", "on an as is", r"distributed under the licen[sc]e is distributed on an as is basis without warranties or conditions of any kind"),
    ("gfdl", "free documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("ofl-1.1", "open font", r"this font software is licen[sc]ed under the sil open font licen[sc]e"),
    ("postgresql", "without a written", r"without fee and without a written agreement is hereby granted"),
    ("cc0", "waived all", r"(?:has )?waived all copyright and related(?: or neighboring)? rights"),
]
# Identifiers that stand behind "SPDX-License-Identifier": label, pattern of the identifier's words.
SPDX = [
    ("mit", "mit"),
    ("isc", "isc"),
    ("zlib", "zlib"),
    ("unlicense", "unlicense"),
    ("wtfpl", "wtfpl"),
    ("boost-1.0", "bsl 1 0"),
    ("apache-1.1", "apache 1 1"),
    ("apache-2.0", "apache 2 0"),
    ("bsd-2-clause", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause"),
    ("bsd-4-clause", "bsd 4 clause"),
    ("gpl-2.0", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", r"gpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", r"lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", r"agpl 3 0(?: only| or later)?"),
    ("gfdl", r"gfdl 1 [123](?: only| or later)?"),
    ("mpl-1.1", "mpl 1 1"),
    ("mpl-2.0", "mpl 2 0"),
    ("epl-1.0", "epl 1 0"),
    ("epl-2.0", "epl 2 0"),
    ("cddl-1.0", "cddl 1 0"),
    ("cpl-1.0", "cpl 1 0"),
    ("eupl-1.2", "eupl 1 2"),
    ("artistic", "artistic [12] 0"),
    ("psf", "psf 2 0"),
    ("postgresql", "postgresql"),
    ("openssl", "openssl"),
    ("ofl-1.1", "ofl 1 1"),
    ("odbl", "odbl 1 0"),
    ("odc-by", "odc by 1 0"),
    ("ms-pl", "ms pl"),
    ("cc0", "cc0 1 0"),
    ("cc-by", "cc by [1234] [05]"),
    ("cc-by-sa", "cc by sa [1234] [05]"),
    ("cc-by-nc", "cc by nc [1234] [05]"),
    ("cc-by-nd", "cc by nd [1234] [05]"),
    ("cc-by-nc-sa", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "cc by nc nd [1234] [05]"),
]
# Words that are searched together, and those looked at on both sides, which are more than any
# rule's place has.
STEP, MARGIN = 96, 48
# Ways to say that a licence holds: priority, weight, the words before its name.
FORMS = [
    (1, 0.5, ""),
    (2, 0.8, r"(?:the )?(?:terms|conditions|text) of (?:the |an? )?"),
    (3, 0.9, r"(?:subject|according|pursuant) to (?:the )?(?:terms of )?(?:the |an? )?"),
    (4, 0.9, r"(?:covered|governed|protected) by (?:the )?(?:terms of )?(?:the |an? )?"),
    (5, 0.95, r"(?:distributed|released|published|provided|offered|available|shared) under (?:the )?(?:terms of )?(?:the |an? )?"),
    (6, 1.0, r"(?:dual |re)?licen[sc]ed under (?:the )?(?:terms of )?(?:the |an? )?"),
    (7, 1.0, r"(?:spdx )?licen[sc]e identifier "),
]


def rules() -> list[dict]:
    """Every name in every form, base phrases first; a pattern matches whole words."""
    base = [
        {"label": label, "keyword": phrase, "pattern": rf"(?<= ){phrase}(?= )", "priority": 0, "weight": 0.5, "base": True}
        for phrase, label in BASE.items()
    ]
    others = [
        {
            "label": label,
            "keyword": keyword,
            "pattern": rf"(?<= ){words}{name}(?= )",
            # A form outranks a weaker one; within a form the more specific label is longer.
            "priority": 100 * priority + len(label),
            "weight": weight,
            "base": False,
        }
        for priority, weight, words in FORMS
        for label, keyword, name in NAMES
    ]
    texts = [
        {"label": label, "keyword": keyword, "pattern": rf"(?<= ){pattern}(?= )", "priority": 900 + len(label), "weight": 1.0, "base": False}
        for label, keyword, pattern in TEXTS
    ]
    spdx = [
        {
            "label": label,
            "keyword": "spdx",
            "pattern": rf"(?<= )spdx licen[sc]e identifier {pattern}(?= )",
            "priority": 800 + len(label),
            "weight": 1.0,
            "base": False,
        }
        for label, pattern in SPDX
    ]
    return base + others + texts + spdx


def gate() -> str:
    """Pattern of the texts that hold some rule's keyword, its first word at the start of a word or in "freebsd"."""
    keywords = dict.fromkeys(r["keyword"] for r in rules())
    # A keyword with another's words in front of its own adds nothing.
    least = [k for k in keywords if not any(k != o and k.startswith(o) for o in keywords)]
    heads: dict[str, list[str]] = {}
    for k in [*least, "freebsd"]:
        heads.setdefault(k[0], []).append(_BETWEEN.join(k[1:].split(" ")))
    phrases = "|".join(rf"{head}(?:{'|'.join(rest)})" for head, rest in heads.items())
    return rf"(?i)(?<!{ANY_CASE_WORD[:-1]})(?:{phrases})"


GATE = gate()
KEYWORDS = list(dict.fromkeys(r["keyword"] for r in rules()))


_PLACES = "array<struct<start:bigint,end:bigint,label:string,priority:int,weight:double>>"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with license_words, license_base and license_found.

    license_words is the number of words; license_base and license_found are arrays of
    (start, end, label, priority, weight), places counted in words.  A text that the gate
    does not let pass is searched no further.  The others are searched STEP words at a time,
    with MARGIN more on both sides, so that the work is in proportion to their length; of
    the rules, only those whose keyword stands among these words are tried.  A found place
    is dropped when another of higher priority, or of the same and longer, covers all of
    its words; of equal places of one label one stays; base places are all kept.

    Null, empty and blank texts have no words and no places.  Equal rows have equal places;
    an empty table gives an empty result.  Existing columns of the three names are replaced,
    others stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    none = F.array().cast(_PLACES)
    # The words are bound once; what is written inside would be evaluated for every window.
    every = F.flatten(F.flatten(F.transform(F.array(words), lambda w: F.transform(_windows(w), _places))))
    docs = docs.withColumns(
        {
            "license_words": F.regexp_count(text, F.lit(ANY_CASE_WORD)).cast("long"),
            "_license_places": F.when(text.rlike(GATE), every).otherwise(none),
        }
    )
    found = F.col("_license_places")
    return docs.withColumns(
        {
            "license_base": F.filter(found, lambda d: d["priority"] == 0),
            "license_found": F.filter(found, lambda d: d["priority"] > 0),
        }
    ).drop("_license_places")


def _windows(words: Column) -> Column:
    """Overlapping stretches of the words that hold a keyword: (first, own, line)."""
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1, F.lit(STEP)))

    def window(at: Column) -> Column:
        first = F.greatest(at - MARGIN, F.lit(0))
        line = F.array_join(F.slice(words, first + 1, at - first + STEP + MARGIN), " ")
        return F.struct(
            first.cast("bigint").alias("first"), at.cast("bigint").alias("own"), F.concat(F.lit(" "), line, F.lit(" ")).alias("line")
        )

    cut = F.transform(F.coalesce(starts, F.array().cast("array<int>")), window)
    return F.filter(cut, lambda w: w["line"].rlike(f"(?:{'|'.join(KEYWORDS)})"))


def _places(window: Column) -> Column:
    """Places that start among a window's own words and that no other covers."""
    kind = "array<struct<label:string,keyword:string,pattern:string,priority:int,weight:double,base:boolean>>"
    by_keyword = [[r for r in rules() if r["keyword"] == k] for k in KEYWORDS]
    table_of = F.from_json(F.lit(json.dumps(by_keyword)), f"array<{kind}>")
    tried = F.flatten(
        F.transform(
            F.filter(
                F.arrays_zip(F.array(*map(F.lit, KEYWORDS)).alias("keyword"), table_of.alias("rules")),
                lambda k: F.contains(window["line"], k["keyword"]),
            ),
            lambda k: k["rules"],
        )
    )

    def of_rule(rule: Column) -> Column:
        spans = F.transform(
            matches(window["line"], rule["pattern"], measure=_blanks),
            lambda m: F.struct(
                (m["start"] - 1 + window["first"]).alias("start"),
                (m["end"] + window["first"]).alias("end"),
                rule["label"].alias("label"),
                rule["priority"].alias("priority"),
                rule["weight"].alias("weight"),
            ),
        )
        return F.when(F.rlike(window["line"], rule["pattern"]), spans).otherwise(F.array().cast(_PLACES))

    def kept(every: Column) -> Column:
        own = F.filter(every, lambda d: (d["start"] >= window["own"]) & (d["start"] < window["own"] + STEP))
        return F.filter(own, lambda d: (d["priority"] == 0) | ~F.exists(every, lambda e: _covers(e, d)))

    return F.get(F.transform(F.array(F.flatten(F.transform(tried, of_rule))), kept), F.lit(0))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _covers(e: Column, d: Column) -> Column:
    over = (e["start"] <= d["start"]) & (d["end"] <= e["end"])
    longer = e["end"] - e["start"] > d["end"] - d["start"]
    return over & ((e["priority"] > d["priority"]) | (e["priority"] == d["priority"]) & longer)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    The score is the largest weight of a kept place, 0 without any.  Odd rows are as in ``scan``.
    """
    found = scan(docs.select("doc_id", "text"))
    base, kept = F.col("license_base"), F.concat("license_base", "license_found")

    def told(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id",
        F.col("license_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        told(base).alias("base_labels"),
        told(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda p: p["weight"])), F.lit(0.0)).alias("score"),
    )


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))
