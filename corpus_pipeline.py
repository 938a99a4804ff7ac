"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Every stage takes all rows that its predecessor kept and, but for the last,
returns the columns of ``documents``.  Between stages the rows are written as
Parquet and read again, so a lost executor costs the current stage at most.

Empty tables pass through every stage; null texts fail the first one; null ids
are kept where a stage's own rules keep them; extra columns travel along,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleforge.llm.line_dedup import dedup_lines
from settleforge.llm.mixing import copies, thresholds, with_sources
from settleforge.llm.near_dedup import near_duplicates
from settleforge.llm.packing import pack_documents
from settleforge.llm.quality import judge_quality
from settleforge.llm.storage import Scratch

#: Ids (8 bytes each) up to which a table of them is sent to every task; larger ones are joined by shuffling.
BROADCAST_IDS = 1_000_000


def _placed(df: DataFrame, names: list[str], have: list[str]) -> DataFrame:
    """The first columns of ``df``, which are ``have`` whatever they are called there, in the order of ``names``."""
    out = df.select(*[F.col(c) for c in df.columns[: len(have)]]).toDF(*have)
    return out.select(*[F.col(f"`{c}`") for c in names])


def _whole(docs: DataFrame) -> DataFrame:
    """Each row as one column, beside which others can have any name."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    rest = [c for c in docs.columns if c != "doc_id"]
    out = judge_quality(docs, measures=False, carry=tuple(rest))
    out = out.toDF(*[f"_{i}" for i in range(len(rest) + 1)], "kept").where("kept")
    return _placed(out, docs.columns, ["doc_id", *rest])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of line runs; those of which no word is left go."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = dedup_lines(docs, carry=tuple(rest))
    out = out.toDF(*[f"_{i}" for i in range(len(rest) + 1)], "n_lines", "n_removed", "kept_text")
    out = out.where((F.col("n_removed") == 0) | F.rlike("kept_text", F.lit(r"[^\x20\x09-\x0D]")))
    have = ["doc_id", *rest, "text", *(["n_chars"] if "n_chars" in docs.columns else [])]
    more = [F.col("kept_text"), *([F.length("kept_text").cast("long")] if "n_chars" in docs.columns else [])]
    return _placed(
        out.select(*[f"_{i}" for i in range(len(rest) + 1)], *[c.alias(f"m{i}") for i, c in enumerate(more)]),
        docs.columns, have
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows with one id are one document; of rows that are equal in id and text one stays.
    """
    gone = Scratch(spark).write(
        near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct(), "gone"
    )
    if not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "text"])
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    rows = _whole(docs)
    return rows.join(gone, F.col("doc.doc_id") == F.col("id"), "left_anti").select("doc.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    rows = _whole(docs).withColumn("source", F.col("doc.source").cast("string"))
    both = with_sources(rows, thresholds(docs)).withColumn("copies", copies(F.col("doc.doc_id"))).where("copies > 0")
    return both.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    out = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
#: SQL cannot say the MinHash components and the tokenizer; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
