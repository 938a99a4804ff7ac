"""License scans as an exact set-similarity join.  Built-in DataFrame functions only.

A text block is a line, or a window of words anywhere in the text, across line
breaks: for a template of n words every ceil(n / threshold) words that follow one
another.  A block meets a template when it holds at least ``THRESHOLD`` of the
template's distinct words.  Words are ordered by their
frequency over all documents, rarest first.  With t words in a template and
o = ceil(threshold * t) needed in common, a block that meets it must share one of
the template's t - o + 1 rarest words (prefix filter), must hold o template words
at all (length filter), and must have enough words left on both sides behind the
shared one (positional filter).  What is left is compared in full.  Windows are
not listed: those that hold a prefix word lie around its places, so the filters
judge the stretch around each place, and the windows of what is left are compared.

The templates are a fixed table of a few hundred words, so the index of their
prefixes is small whatever the corpus; the documents are read twice, once to
count and once to scan, and only documents with a prefix word go on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch

THRESHOLD = 0.8

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Usual license notices and their labels.
TEMPLATES = {
    "agpl": "licensed under the gnu affero general public license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "released under the mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text in order: runs of digits, a-z (A-Z lower-cased) and all that is not ASCII; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(low, _GAP), "")


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _phrase_places(words: Column, phrase: str) -> Column:
    """Start of each place where the phrase's words stand one after another."""
    p = phrase.split()

    def here(i: Column) -> Column:
        ok = F.lit(True)
        for k, w in enumerate(p):
            ok = ok & (F.get(words, i + k) == w)
        return ok

    return F.filter(F.sequence(F.lit(0), F.size(words) - len(p)), here)


def word_frequencies(docs: DataFrame, text_col: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of a fixed vocabulary stands; a row a word comes to the driver."""
    one = docs.select(F.explode(F.array_intersect(words_of(F.col(text_col)), _strings(vocabulary))).alias("w"))
    return {r["w"]: r["n"] for r in one.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def _window_hits(docs: DataFrame, table: DataFrame, rare: list[str], wide: int) -> DataFrame:
    """(row, line_no, label, c) of the best window around each place of a prefix word, where it meets the template."""
    tokens = F.flatten(
        F.transform("lines", lambda x, k: F.transform(words_of(x), lambda w: F.struct(w.alias("w"), k.alias("line"))))
    )
    texts = docs.where("lines IS NOT NULL").select("row", tokens.alias("tokens"))
    # The words around a place from which the widest window can reach it, and the place among them.
    places = F.filter(F.sequence(F.lit(1), F.size("tokens")), lambda p: F.element_at("tokens", p)["w"].isin(rare))
    first = lambda p: F.greatest(p - (wide - 1), F.lit(1))
    around = F.transform(
        places,
        lambda p: F.struct(
            F.element_at("tokens", p)["w"].alias("w"), (p - first(p) + 1).alias("p"),
            F.slice("tokens", first(p), p - first(p) + wide).alias("near")
        )
    )
    near = texts.select("row", F.explode(around).alias("x")).select("row", "x.*").join(F.broadcast(table), "w")
    begin = F.greatest(F.col("p") - F.col("span") + 1, F.lit(1))
    words = F.transform("near", lambda x: x["w"])
    near = near.withColumn("words", words).withColumn("begin", begin)
    # A window of which this is the rarest word holds none before it, so those behind it must do.
    behind = F.slice("t_words", F.col("t_at") + 1, F.col("t"))
    near = near.where(
        F.size(
            F.array_intersect(F.slice("words", F.col("begin"), F.col("p") - F.col("begin") + F.col("span")), behind)
        ) >= F.col("need")
    )
    starts = F.filter(F.sequence("begin", "p"), lambda i: F.array_contains("t_words", F.element_at("words", i)))
    best = F.array_max(
        F.transform(
            starts,
            lambda i: F.struct(
                F.size(F.array_intersect(F.slice("words", i, F.col("span")), F.col("t_words"))).alias("common"),
                i.alias("i")
            )
        )
    )
    near = near.withColumn("best", best).where(F.col("best.common") >= F.col("need"))
    return near.select(
        "row", F.element_at("near", F.col("best.i"))["line"].alias("line_no"), "label",
        (F.col("best.common") / F.col("t")).alias("c")
    )


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Find license phrases and license blocks.

    Returns a row for each input row: the id, ``n_words``, ``n_base`` (places of
    phrases), ``first_word`` and ``last_word`` (smallest and largest start of a
    phrase, or null), ``base_labels``, ``labels`` (with those of the blocks),
    ``score`` (the largest containment of a template in a block; 1 where a
    phrase stands) and ``matches`` (array of struct line, label, containment;
    for a window the line of its first word).

    * null and empty texts have no words, empty labels and score 0; null ids stay null;
    * repeated rows are scanned each on its own; an empty table gives no rows;
    * whole texts are scanned; other columns are ignored.
    """
    spark = docs.sparkSession
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    sets = {k: sorted(set(v.split())) for k, v in templates.items()}
    vocabulary = sorted(set().union(*sets.values()))
    seen = word_frequencies(docs, text_col, vocabulary)
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    index = []
    for label, words in sets.items():
        words, need = sorted(words, key=order.get), math.ceil(round(threshold * len(words), 9))
        span = math.ceil(round(len(templates[label].split()) / threshold, 9))
        index += [(w, label, at, len(words), need, words, span) for at, w in enumerate(words[: len(words) - need + 1])]
    rare = sorted({r[0] for r in index})
    least, wide = min(r[4] for r in index), max(r[6] for r in index)

    # One pass: what the result needs of each document, and the lines of those that hold a prefix word.
    text = F.col(text_col).cast("string")
    read = docs.select(F.col(id_col).alias("id"), text.alias("text"), words_of(text).alias("words"))
    n = F.size("words")
    places = {
        p: F.when(
            (n >= len(p.split())) & F.array_contains("words", max(p.split(), key=len)),
            _phrase_places(F.col("words"), p)
        ).otherwise(F.array().cast("array<int>")) for p in phrases
    }
    lines = F.when(F.arrays_overlap("words", _strings(rare)), F.split("text", "\n", -1))
    read = read.select(
        F.monotonically_increasing_id().alias("row"), "id", n.cast("long").alias("n_words"),
        F.array(*places.values()).alias("places"), lines.alias("lines")
    )
    docs_ = Scratch(spark).write(read, "licenses")

    rank = F.create_map(*[x for w, i in order.items() for x in (F.lit(w), F.lit(i))])
    own = F.array_intersect(words_of(F.col("line")), _strings(vocabulary))
    blocks = docs_.where("lines IS NOT NULL").select("row", F.posexplode("lines").alias("line_no", "line"))
    blocks = blocks.select(
        "row", "line_no",
        F.transform(
            F.array_sort(F.transform(own, lambda w: F.struct(rank[w].alias("r"), w.alias("w")))), lambda x: x["w"]
        ).alias("ws")
    ).where(F.size("ws") >= least)
    heads = blocks.select(
        "row", "line_no", "ws", F.posexplode(F.slice("ws", F.lit(1), F.size("ws") - least + 1)).alias("at", "w")
    )
    table = spark.createDataFrame(
        index, "w string, label string, t_at int, t int, need int, t_words array<string>, span int"
    )
    near = heads.join(F.broadcast(table), "w")
    near = near.where(
        (F.size("ws") >= F.col("need")) & (
            F.least(F.size("ws") - F.col("at"), F.col("t") - F.col("t_at")) >= F.col("need")
        )
    )
    common = F.size(F.array_intersect("ws", "t_words"))
    hits = near.where(common >= F.col("need")).select(
        "row", "line_no", "label", (common / F.col("t")).alias("c")
    ).distinct()
    hits = hits.unionByName(
        _window_hits(docs_, table, rare, wide)
    ).groupBy("row", "line_no", "label").agg(F.max("c").alias("c"))
    hits = hits.groupBy("row").agg(
        F.array_sort(F.collect_set("label")).alias("more"), F.max("c").alias("c"),
        F.array_sort(
            F.collect_list(F.struct(F.col("line_no").alias("line"), "label", F.col("c").alias("containment")))
        ).alias("matches")
    )

    out = docs_.drop("lines").join(hits, "row", "left")
    every = F.flatten("places")
    found = F.filter(
        F.array(*[F.when(F.size(F.col("places")[i]) > 0, F.lit(label)) for i, label in enumerate(phrases.values())]),
        lambda x: x.isNotNull()
    )
    labels = F.array_sort(F.array_distinct(F.concat(found, F.coalesce("more", F.array().cast("array<string>")))))
    score = F.greatest(F.coalesce("c", F.lit(0.0)), F.when(F.size(every) > 0, 1.0).otherwise(0.0))
    return out.select(
        F.col("id").alias(id_col), "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"),
        F.coalesce(
            "matches", F.array().cast("array<struct<line: int, label: string, containment: double>>")
        ).alias("matches")
    )


def oracle(table: str = "documents") -> str:
    """The same scan in SQL: every line against every template, without filters."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    parts, rows = [], []
    for p, label in PHRASES.items():
        ws = p.split()
        parts.append(
            f"SELECT r, i, '{label}' AS label FROM p WHERE " + " AND ".join(
                f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(ws)
            )
        )
    for label, t in TEMPLATES.items():
        ws = sorted(set(t.split()))
        rows.append(f"('{label}', {ws}, {len(ws)}, {math.ceil(round(THRESHOLD * len(ws), 9))})")
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {low} AS t FROM {table}),
e AS (SELECT doc_id, r, t, regexp_extract_all(t, '{word}') AS w FROM d),
p AS (SELECT r, w, unnest(range(len(w))) AS i FROM e),
b AS ({' UNION ALL '.join(parts)}),
bb AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY r),
l AS (SELECT r, list_distinct(regexp_extract_all(x, '{word}')) AS ws FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM e)),
m(label, ws, n, need) AS (VALUES {', '.join(rows)}),
h AS (SELECT r, label, len(list_intersect(l.ws, m.ws)) / n AS c FROM l, m WHERE len(list_intersect(l.ws, m.ws)) >= need),
g AS (SELECT r, max(c) AS c FROM h GROUP BY r),
a AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM b UNION ALL SELECT r, label FROM h) GROUP BY r)
SELECT e.doc_id, len(e.w)::BIGINT AS n_words, coalesce(bb.n, 0)::BIGINT AS n_base, bb.a::BIGINT AS first_word, bb.z::BIGINT AS last_word,
       coalesce(bb.labels, '') AS base_labels, coalesce(a.labels, '') AS labels, greatest(coalesce(g.c, 0.0), CASE WHEN bb.n > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM e LEFT JOIN bb ON e.r = bb.r LEFT JOIN g ON e.r = g.r LEFT JOIN a ON e.r = a.r"""
