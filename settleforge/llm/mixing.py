"""Mixing sources to target weights with hash-threshold histograms.

A source's target is met by whole copies of all its documents plus one more copy
of those whose hash is below a threshold.  The threshold is found without sorting
documents: sizes are summed by source and hash bucket, the bucket in which the
budget runs out is found from the sums, and only that bucket is split again, 12
hash bits at a time, until it is one hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import Scratch

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (3, 1, 2)
HASH_BITS, STEP_BITS = 60, 12
#: Sources, and bytes of their names, up to which their table is sent to every task; more are joined by shuffling.
BROADCAST_SOURCES, BROADCAST_BYTES = 50_000, 8 << 20


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_of(id_col: Column, seed: str = "") -> Column:
    """60 bits that depend on the id and the seed alone."""
    return F.conv(
        F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 15), 16, 10
    ).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_num: int = 3, share_den: int = 2, most: int = 2
) -> DataFrame:
    """Targets by source from (source, source_size): ``share`` of all sizes by weight, none above ``most`` times its size.

    What a source cannot take is shared again by weight, until none is above its
    bound: every source gets min(bound, level * weight) for one common level,
    found from running sums in the order of bound / weight.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    lcm = 1
    for x in weights:
        lcm *= x
    t = sizes.withColumn("weight", w).withColumn("bound", F.col("source_size") * most)
    t = t.withColumn("order", (F.col("bound") * lcm / F.col("weight")).cast("long"))
    before = Window.orderBy("order", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    t = t.withColumns(
        {
            "all_size": F.sum("source_size").over(every), "all_weight": F.sum("weight").over(every),
            "bound_before": F.coalesce(F.sum("bound").over(before), F.lit(0)),
            "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0))
        }
    )
    left = share_num * F.col("all_size") - share_den * F.col("bound_before")
    part = share_den * (F.col("all_weight") - F.col("weight_before"))
    free = left * F.col("weight") <= F.col("bound") * part
    # The level of the first source that its bound does not hold.
    first = Window.orderBy("order", F.col("source").asc_nulls_last())
    t = t.withColumns({"left": left, "part": part, "free": free, "n": F.row_number().over(first)})
    level = F.min(F.when(F.col("free"), F.struct("n", "left", "part"))).over(every)
    t = t.withColumn("level", level)
    capped = F.col("level").isNull() | (F.col("n") < F.col("level.n"))
    target = F.when(capped, F.col("bound").cast("double")).otherwise(
        (F.col("level.left") * F.col("weight")).cast("double") / F.col("level.part").cast("double")
    )
    return t.select("source", "source_size", "weight", target.alias("target"))


def _small(sources: DataFrame) -> bool:
    """Whether a table by source is bounded, in rows and in bytes, well enough to go to every task."""
    x = sources.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("source")).alias("b")).first()
    return x["n"] <= BROADCAST_SOURCES and (x["b"] or 0) <= BROADCAST_BYTES


def with_sources(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by ``source``, null being a source; ``right`` has a row a source."""
    right = (F.broadcast(right) if _small(right) else right).withColumnRenamed("source", "_s")
    return left.join(right, left["source"].eqNullSafe(right["_s"]), how).drop("_s")


def thresholds(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: tuple[int, ...] = WEIGHTS, seed: str = ""
) -> DataFrame:
    """A row a source: ``source``, ``source_size``, ``target``, ``full`` (copies of every document), ``lo`` and ``take``.

    A document gets one copy more if its hash is below ``lo``, or is ``lo`` and ``take`` holds.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    # Only what the histograms read: the choice itself needs no table of documents.
    base = scratch.write(
        docs.select(
            F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
            hash_of(F.col(id_col), seed).alias("h")
        ),
        "sizes"
    )
    sources = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = scratch.write(
        sources.withColumn("full", full).withColumn("budget", F.col("target") - F.col("full") * F.col("source_size")),
        "sources"
    )
    # edge: (source, bits read so far, words below them, budget).
    edge, shift = sources.select(
        "source", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"), "budget"
    ), HASH_BITS
    while shift:
        step = min(STEP_BITS, shift)
        rows = with_sources(base.where("size > 0"), edge.select("source", "prefix", "below", "budget"))
        if shift < HASH_BITS:
            rows = rows.where(F.shiftright("h", shift) == F.col("prefix"))
        shift -= step
        sums = rows.groupBy("source", "below", "budget", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        upto = F.sum("size").over(
            Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ) + F.col("below")
        sums = sums.withColumn("upto", upto).where(F.col("upto") > F.col("budget"))
        cut = sums.groupBy("source").agg(F.min(F.struct("bucket", "upto", "size", "budget", "lo", "hi")).alias("c")).select(
            "source", F.col("c.bucket").alias("prefix"), (F.col("c.upto") - F.col("c.size")).alias("below"),
            F.col("c.budget").alias("budget"), F.col("c.size").alias("size"), F.col("c.lo").alias("lo"),
            F.col("c.hi").alias("hi")
        )
        edge = scratch.write(cut, "edge")
        if edge.where("lo <> hi").isEmpty():
            break
    # The last bucket holds one hash: take it if that brings the source nearer to its budget.
    last = edge.select("source", "lo", (F.col("below") + F.col("size") / 2 <= F.col("budget")).alias("take"))
    return scratch.write(with_sources(sources.drop("budget", "weight"), last, "left"), "thresholds")


def copies(id_col: Column, seed: str = "") -> Column:
    """How often the mix takes a document whose row holds its source's threshold."""
    h = hash_of(id_col, seed)
    return F.col("full") + F.coalesce(
        (h < F.col("lo")) | ((h == F.col("lo")) & F.col("take")), F.lit(False)
    ).cast("int")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: tuple[int, ...] = WEIGHTS, seed: str = ""
) -> DataFrame:
    """How often the mix takes each document.

    Returns a row for each input row: ``doc_id``, ``size`` (words), ``source``,
    ``source_size``, ``target`` (the source's), ``copies`` (0, 1 or 2) and
    ``taken`` (= copies * size).  A source's taken words differ from its target
    by at most half the size of one document (of the rows with one hash).

    * a null source is a source of its own and comes last; null text has size 0;
    * repeated rows and rows with one id share a hash and are taken alike;
    * an empty source has target 0; an empty table gives no rows;
    * the choice depends on ids, sizes and the seed, so reruns agree.
    """
    limits = thresholds(docs, id_col, text_col, source_col, weights=weights, seed=seed)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size")
    )
    out = with_sources(rows, limits).withColumn("copies", copies(F.col("doc_id"), seed))
    return out.select(
        "doc_id", "size", "source", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def oracle(table: str = "documents") -> str:
    """The same mix in SQL, by sorting."""
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM {table}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS bound FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY bound * 6 // weight, source NULLS LAST) AS n FROM w),
p AS (SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(bound) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
             2 * (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS p FROM o),
k AS (SELECT min(n) AS n FROM p WHERE l * weight <= bound * p),
t AS (SELECT p.source, p.source_size, CASE WHEN k.n IS NULL OR p.n < k.n THEN p.bound::DOUBLE ELSE (q.l * p.weight)::DOUBLE / q.p::DOUBLE END AS target
      FROM p CROSS JOIN k LEFT JOIN p q ON q.n = k.n),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS f FROM t),
r AS (SELECT d.*, b.source_size, b.target, b.f, b.target - b.f * b.source_size AS budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY d.source, h) AS own
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, ((f + CASE WHEN size > 0 AND (upto - own) + own / 2 <= budget THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM r"""
