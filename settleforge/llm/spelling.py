"""Groups of spelling variants: an even-partition pigeonhole join of words that differ by one edit.

Of two words that differ by one inserted, deleted or replaced code point, the
shorter (or, of equal ones, either) is cut into two even segments: the edit lies
in one of them, so the other one stands in both words, at the front or counted
from the end.  Words are therefore indexed by both segments of their own length;
a word probes with its segments for its own length and for one code point less.
Buckets of words with one segment in common are joined and each candidate is
verified.

A common beginning or end would make buckets that grow with the vocabulary, so a
bucket of more than ``bucket_words`` words is cut again: what is left between the
shared front and the shared end is halved by the same rule, until the bucket is
small or one code point is left.  Only words that agree everywhere but in one
place then remain together, at most as many as the alphabet has letters.  No
bucket is skipped.

Everything is DataFrame code.  Occurrences are counted with partial sums before
the shuffle, so a word that makes up a third of the corpus is one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch

#: A word of the corpus: a maximal run of these.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a bucket above which it is cut again.
BUCKET_WORDS = 64
_KEY = ("l", "p", "q", "front", "back")


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 7, min_count: int = 2,
    drop_every: int | None = None
) -> DataFrame:
    """(word, n): lower-cased runs of letters with their occurrences in whole texts.

    With ``drop_every`` a run whose checksum, with its document's id, is divided by
    it loses one code point, which plants misspellings.  Null texts have no words;
    a null id counts as empty text in the checksum.
    """
    runs = F.regexp_extract_all(
        F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0)
    )
    df = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.explode(runs).alias("r")
    ).select("i", F.translate("r", UPPER, LOWER).alias("r"))
    word = F.col("r")
    if drop_every:
        h = F.crc32(F.concat("i", F.lit(":"), "r").cast("binary"))
        at = (h % F.length("r")).cast("int")
        cut = F.concat(F.substring("r", F.lit(1), at), F.substring("r", at + 2, F.length("r")))
        word = F.when(h % drop_every == 0, cut).otherwise(word)
    counts = df.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


def _ends(p: Column, q: Column) -> list[Column]:
    return [
        p.alias("p"), q.alias("q"), F.substring("word", F.lit(1), p).alias("front"),
        F.substring("word", F.length("word") - q + 1, q).alias("back")
    ]


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of what is left joined to the shared front, and with the second to the end."""
    m = F.col("l") - F.col("p") - F.col("q")
    m1 = (m / 2).cast("int")
    front = rows.select("word", "n", "l", *_ends(F.col("p") + m1, F.col("q")))
    return front.unionByName(rows.select("word", "n", "l", *_ends(F.col("p"), F.col("q") + m - m1)))


def _pairs(rows: DataFrame) -> DataFrame:
    """Verified pairs inside buckets."""
    x = rows.where(F.length("word") == F.col("l")).select(*_KEY, F.col("word").alias("x"), F.col("n").alias("xn"))
    y = rows.select(*_KEY, F.col("word").alias("y"), F.col("n").alias("yn"))
    both = x.join(y, list(_KEY)).where((F.length("y") > F.col("l")) | (F.col("y") > F.col("x")))
    return both.where(F.levenshtein("x", "y", 1) == 1).select("x", "xn", "y", "yn")


def near_words(words: DataFrame, *, min_length: int = 7, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(x, xn, y, yn): every pair of different words that one edit turns into each other, once.

    ``words`` has distinct ``word`` and ``n``; of equal lengths x < y, else x is the shorter one.
    """
    scratch = Scratch(words.sparkSession)
    lengths = F.array(F.length("word"), F.length("word") - 1)
    rows = words.select("word", "n", F.explode(lengths).alias("l")).where(F.col("l") >= min_length)
    rows = _halved(rows.withColumns({"p": F.lit(0), "q": F.lit(0)}))
    found, left = None, True
    while left:
        rows = scratch.write(rows, "segments")
        wide = rows.where(F.col("l") - F.col("p") - F.col("q") > 1).groupBy(*_KEY).count()
        wide = scratch.write(wide.where(F.col("count") > bucket_words).drop("count"), "wide")
        left = not wide.isEmpty()
        done = _pairs(rows.join(wide, list(_KEY), "left_anti") if left else rows)
        found = done if found is None else found.unionByName(done)
        if left:
            rows = _halved(rows.join(wide, list(_KEY), "left_semi"))
    return scratch.write(found.distinct(), "near")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) from (word, form): links are doubled until none leads on.

    A form occurs ten times as often as its word, so chains have some twenty links at most.
    """
    up = scratch.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if up.join(on, "root", "left_semi").isEmpty():
            return up
        up = scratch.write(
            up.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots"
        )


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 7, min_count: int = 2,
    ratio: int = 10, drop_every: int | None = None, bucket_words: int = BUCKET_WORDS
) -> DataFrame:
    """Words with the form that each is taken for a variant of, and the root that forms lead to.

    Returns (word, form, root, n, n_near, form_n).  The form is the near word with
    the most occurrences (ties: the first in code-point order) if it has ``ratio``
    times the word's; else null, and the word is its own root.

    * null and empty texts have no words; a null id is an empty text in checksums;
    * repeated rows count each; other columns are ignored, whatever their names;
    * an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    words = scratch.write(
        word_counts(docs, id_col, text_col, min_length=min_length, min_count=min_count, drop_every=drop_every), "words"
    )
    links = near_words(words, min_length=min_length, bucket_words=bucket_words)
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("x").alias("word"), F.col("y").alias("o"), F.col("yn").alias("k")),
                F.struct(F.col("y").alias("word"), F.col("x").alias("o"), F.col("xn").alias("k")),
            )
        ).alias("e")
    ).select("e.*")
    best = ends.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("k")).alias("k"), "o")).alias("best")
    )
    df = words.join(best, "word", "left")
    ok = -F.col("best.k") >= ratio * F.col("n")
    df = scratch.write(
        df.select(
            "word", F.when(ok, F.col("best.o")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ok, -F.col("best.k")).alias("form_n")
        ), "forms"
    )
    roots = _roots(df.where("form IS NOT NULL"), scratch)
    return df.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def oracle(drop_every: int = 31, min_length: int = 7) -> str:
    """The same in DuckDB: a bitwise checksum, deletion neighbourhoods instead of segments, recursion along forms."""
    bits = "list_concat([get_byte(b, i)], [-1, -1, -1, -1, -1, -1, -1, -1])"
    bits = bits.replace("get_byte(b, i)", "('0x' || substr(b, 2 * i + 1, 2))::BIGINT")
    crc = (
        f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(length(b) // 2), "
        f"lambda i: {bits}))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"
    )
    return f"""WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS i,
  translate(unnest(regexp_extract_all(text, '[{LETTERS}]+')), '{UPPER}', '{LOWER}') AS r FROM documents),
 once AS (SELECT i, r, count(*) AS k, hex(encode(i || ':' || r)) AS b FROM runs WHERE length(r) >= {min_length} GROUP BY i, r),
 summed AS (SELECT r, k, {crc} AS h FROM once),
 cut AS (SELECT CASE WHEN h % {drop_every} = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, k FROM summed),
 words AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= {min_length} GROUP BY word HAVING sum(k) >= 2),
 dels AS MATERIALIZED (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
 ends AS (SELECT a.word, b.word AS o, b.n AS k FROM dels a JOIN dels b ON a.d = b.d AND a.p = b.p AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT d.word, w.word, w.n FROM dels d JOIN words w ON w.word = d.d UNION SELECT w.word, d.word, d.n FROM dels d JOIN words w ON w.word = d.d),
 best AS (SELECT word, count(*) AS n_near, arg_min(o, (-k, o)) AS o, max(k) AS k FROM ends GROUP BY word),
 forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN k >= 10 * n THEN o END AS form, CASE WHEN k >= 10 * n THEN k END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
 walk AS (SELECT word, word AS last FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.last WHERE forms.form IS NOT NULL),
 roots AS (SELECT word, last AS root FROM walk WHERE last NOT IN (SELECT word FROM forms WHERE form IS NOT NULL))
 SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
