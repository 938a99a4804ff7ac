"""Line dedup by winnowing over line hashes.  Built-in DataFrame functions only.

A *run* is one or more lines in a row that hold at least ``min_words`` words; blank
lines between them do not count.  A line is removed if it lies in a run that also
starts earlier, a blank one if the nearest others on both sides are removed.  Every such run is the union of
its *windows*: runs that hold too few words without their last, or without their
first, line.  A window has at most ``min_words`` lines.

1. Winnowing: each window selects the smallest of its lines' hashes (the last
   place where ties), so a run that repeats is bound to repeat a selected
   *fingerprint*.  A place counts once however many windows select it.
2. Fingerprints that stand at one place only are dropped with all their windows.
3. The places of shared fingerprints are joined, and from each the match is
   extended both ways over the windows that hold it; equal windows (128-bit
   hashes) meet, and all but the earliest place of each are late.
4. The lines of late windows, united, are cut out, and blank ones between them.

A window that repeats always repeats its fingerprint, so step 2 loses nothing.
Counts and earliest places are aggregates with partial sums before the shuffle.
The joins that mark places carry a salt on both sides, so a line that a third of
all documents share is dealt over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch

#: Words that a repeated run of lines must have to be removed.
MIN_WORDS = 5
#: Parts over which the places of one fingerprint, or of one window, are dealt.
SALTS = 16
_WORD = r"[^\x20\x09-\x0D]+"


def _lines(text: Column) -> Column:
    """A document's lines; null has none, an empty text has one."""
    return F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))


def _word_count(line: Column, most: int) -> Column:
    """Words of a line, ``most`` at most; of a line with more only the beginning is read."""
    many = r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){%d}[^\x20\x09-\x0D]" % (most - 1)
    return F.when(F.rlike(line, F.lit(many)), F.lit(most)).otherwise(F.regexp_count(line, F.lit(_WORD)))


def _reach(lines: Column, min_words: int) -> Column:
    """(words, lines) of the shortest beginning of ``lines`` that has enough words, or of all of them."""
    none = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"))
    return F.aggregate(
        lines, none, lambda a,
        x: F.when(a["w"] >= min_words, a).otherwise(F.struct((a["w"] + x["w"]).alias("w"), (a["n"] + 1).alias("n")))
    )


def _windows_of(own: Column, min_words: int) -> Column:
    """The windows of a document, from its lines that are not blank: (h, g, w, p)."""

    def ahead(i: Column) -> Column:
        r = _reach(F.slice(own, i, min_words), min_words)
        some = F.struct((r["w"] >= min_words).alias("ok"), i.alias("start"), r["n"].alias("n"))
        return F.when(
            F.element_at(own, i)["w"] >= min_words,
            F.struct(F.lit(True).alias("ok"), i.alias("start"), F.lit(1).alias("n"))
        ).otherwise(some)

    def behind(i: Column) -> Column:
        start = F.greatest(i - min_words + 1, F.lit(1))
        r = _reach(F.reverse(F.slice(own, start, i - start + 1)), min_words)
        # Those that reach just far enough from their first line on are there already.
        new = (r["w"] >= min_words) & (r["w"] - F.element_at(own, i)["w"] >= min_words)
        some = F.struct(new.alias("ok"), (i - r["n"] + 1).alias("start"), r["n"].alias("n"))
        return F.when(
            F.element_at(own, i)["w"] >= min_words,
            F.struct(F.lit(False).alias("ok"), i.alias("start"), F.lit(1).alias("n"))
        ).otherwise(some)

    def window(x: Column) -> Column:
        lines = F.slice(own, x["start"], x["n"])
        least = F.array_min(F.transform(lines, lambda y: F.struct(y["h"].alias("h"), (-y["p"]).alias("p"))))
        chain = lambda k, c: F.aggregate(
            lines, F.lit(k).cast("long"), lambda a, y: F.xxhash64(a, y[c])
        ).alias(f"w{k}")
        ends = F.element_at(own, x["start"])["p"].alias("first"), F.element_at(
            own, x["start"] + x["n"] - 1
        )["p"].alias("last")
        return F.struct(least.alias("f"), *ends, chain(1, "h"), chain(2, "g"))

    every = F.sequence(F.lit(1), F.size(own))
    runs = F.concat(F.transform(every, ahead), F.transform(every, behind))
    return F.transform(F.filter(runs, lambda x: x["ok"]), window)


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """From (id, row, lines): id, row, f, at, first, last, w1, w2 of each window.

    ``f`` is the fingerprint and ``at`` its place, ``first`` and ``last`` are the first
    and last line, ``w1`` and ``w2`` two independent hashes of the window's lines.
    """
    one = lambda x, i: F.struct(
        F.xxhash64(x).alias("h"), F.xxhash64(F.lit(min_words), x).alias("g"), _word_count(x, min_words).alias("w"),
        i.alias("p")
    )
    own = F.filter(F.transform("lines", one), lambda x: x["w"] > 0)
    # As a lambda's variable the array is made once, not again for every element that looks into it.
    found = F.element_at(F.transform(F.array(own), lambda x: F.when(F.size(x) > 0, _windows_of(x, min_words))), 1)
    return docs.select("id", "row", F.explode(found).alias("x")).select(
        "id", "row", F.col("x.f.h").alias("f"), (-F.col("x.f.p")).alias("at"), "x.first", "x.last", "x.w1", "x.w2"
    )


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def late_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, row, line) of each line of a run that stands earlier too; a line may come twice."""
    each = Scratch(docs.sparkSession).write(windows(docs, min_words), "windows")
    place = F.struct("id", "row", "at")
    shared = each.groupBy("f").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a < z").select("f")
    each = each.withColumn("salt", F.pmod(F.xxhash64("id", "row"), F.lit(SALTS)).cast("int"))
    near = each.join(_salted(shared), ["f", "salt"], "left_semi")
    earliest = near.groupBy("w1", "w2").agg(
        F.min(F.struct("id", "row", "first")).alias("a"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").drop("n")
    late = near.join(_salted(earliest), ["w1", "w2", "salt"]).where(F.struct("id", "row", "first") > F.col("a"))
    return late.select("id", "row", F.explode(F.sequence("first", "last")).alias("line"))


def _kept_parts() -> Column:
    """The stretches (first line, line after the last) that stay, from sorted ``starts``, ``lines`` and ``n_lines``."""
    s = F.col("starts")
    m = F.size(s)
    # Ends of runs of late lines, and where the next run begins.
    edge = F.filter(
        F.sequence(F.lit(1), m), lambda i: (i == m) | (F.element_at(s, F.least(i + 1, m)) > F.element_at(s, i) + 1)
    )
    after = F.transform(
        edge,
        lambda i: F.struct(
            (F.element_at(s, i) + 1).alias("at"),
            F.when(i == m, F.col("n_lines")).otherwise(F.element_at(s, F.least(i + 1, m))).alias("to")
        )
    )
    head = F.array(F.struct(F.lit(0).alias("at"), F.element_at(s, 1).alias("to")))
    # What is blank between two late lines goes with them.
    inner = lambda x: (x["at"] > 0) & (x["to"] < F.col("n_lines"))
    full = lambda x: F.exists(
        F.slice("lines", x["at"] + 1, x["to"] - x["at"]), lambda y: F.rlike(y, F.lit(_WORD))
    )
    return F.filter(F.concat(head, after), lambda x: (x["to"] > x["at"]) & (~inner(x) | full(x)))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = MIN_WORDS,
    carry: tuple[str, ...] = ()
) -> DataFrame:
    r"""Remove each line that lies in a run of lines with ``min_words`` words or more which also starts earlier.

    Lines are what stands between ``\n``; they count unchanged.  A word is a run
    of characters other than ASCII white space; a line without one is blank, and
    goes if the nearest lines before and after it that are not blank both go.  "Earlier" is a smaller
    id (null first), then the smaller hash of the text for rows with one id, then
    an earlier line, as the input stands.  Returns a row for each input row: the
    id, the ``carry`` columns, ``n_lines``, ``n_removed`` (long) and ``kept_text``
    (the other lines joined by ``\n``); carried columns may have any names but these.

    * null text: no lines, kept text null; empty text: one empty line;
    * runs of fewer words stay wherever they repeat, as do parts of a line;
    * rows with one id and one text cannot be told apart: each keeps what it would keep alone;
    * an empty table gives no rows; a document whose lines all go keeps an empty text.
    """
    text = F.col(text_col).cast("string")
    src = docs.select(
        F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], text.alias("text"),
        F.xxhash64(text).alias("row")
    )
    late = late_lines(
        src.select("id", "row", _lines(F.col("text")).alias("lines")), min_words
    ).groupBy("id", "row").agg(F.array_sort(F.collect_set("line")).alias("starts"))
    late = late.select(F.col("id").alias("late_id"), F.col("row").alias("late_row"), "starts")
    both = src.join(late, src["id"].eqNullSafe(late["late_id"]) & (src["row"] == late["late_row"]), "left")
    both = both.withColumn(
        "lines", F.when(F.col("starts").isNotNull(), _lines(F.col("text")))
    ).withColumn("n_lines", F.size("lines"))
    parts = _kept_parts()
    kept = F.flatten(F.transform(parts, lambda x: F.slice("lines", x["at"] + 1, x["to"] - x["at"])))
    both = both.withColumn("kept", F.when(F.col("starts").isNotNull(), kept))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(
        F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    ).cast("long")
    removed = F.when(F.col("starts").isNotNull(), F.col("n_lines") - F.size("kept")).otherwise(0).cast("long")
    out = F.when(F.col("starts").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("text"))
    return both.select(
        F.col("id").alias(id_col), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], n_lines.alias("n_lines"),
        removed.alias("n_removed"), out.alias("kept_text")
    )


def oracle(table: str = "documents", min_words: int = MIN_WORDS) -> str:
    """The same lines in SQL, from all runs of at most ``min_words`` lines and without fingerprints."""
    return rf"""
WITH d AS (SELECT doc_id, text, coalesce(string_split(text, chr(10)), []) AS l FROM {table}),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
b AS (SELECT doc_id, list({{'l': line, 'n': n, 'p': i}} ORDER BY i) AS l FROM (SELECT *, len(regexp_extract_all(line, '[^ 	-
]+')) AS n FROM x) WHERE n > 0 GROUP BY doc_id),
r AS (SELECT doc_id, l[i].p AS a, l[i + k].p AS z, l[i:i + k] AS s FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM b), range({min_words}) t(k) WHERE i + k <= len(l)),
w AS (SELECT doc_id, a, z, [y.l FOR y IN s] AS k FROM r WHERE list_sum([y.n FOR y IN s]) >= {min_words}),
late AS (SELECT doc_id, a, z FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, a) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, z + 1)) AS i FROM late),
v AS (SELECT x.*, CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN gone.i IS NOT NULL END AS g FROM x LEFT JOIN gone ON x.doc_id = gone.doc_id AND x.i = gone.i),
y AS (SELECT doc_id, line, i, coalesce(g, last_value(g IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AND first_value(g IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), false) AS g FROM v),
z AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (g) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT g), '') AS t FROM y GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(CASE WHEN d.text IS NULL THEN NULL ELSE t END) AS kept_sha256
FROM d LEFT JOIN z ON d.doc_id = z.doc_id"""
