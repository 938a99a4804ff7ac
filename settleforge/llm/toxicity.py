"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features are the distinct words, word pairs and skip-one pairs of a text, hashed
into 2^20 coordinates; a coordinate counts once however often it occurs.  FTRL
gives each coordinate its own learning rate and, through L1, an exact zero to
most of them, so the model is a short list of (coordinate, weight) that every
task can hold.

The model is fitted on a bounded sample of the labelled rows
(``max_train`` of them, chosen by a hash of the id) in one task; all rows are
scored, on whole texts, in one pass without a shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .packing import slices
from .storage import bound_batches

BITS = 20
#: Labelled rows that the model is fitted on, at most.
MAX_TRAIN = 20_000
SLICE_BYTES = 4 << 20
#: Letters, digits and every byte of a non-ASCII character.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = True
_INSIDE[0x80:] = True


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate and row of every word, pair and skip pair; repeats stay in."""
    buf = T.LOWER[buf]
    s, e, woff = T.spans(buf, off, _INSIDE)
    h, row = T.hash_spans(buf, s, e), T.row_of(woff)
    shift = np.uint64(64 - BITS)
    at, rows = [(T.mix(h) >> shift).astype(np.int32)], [row]
    for gap, salt in ((1, 0x9FB21C651E98DF25), (2, 0x2545F4914F6CDD1D)):
        ok = np.flatnonzero(row[:-gap] == row[gap:])
        at.append((T.mix(h[ok] * np.uint64(salt) + h[ok + gap]) >> shift).astype(np.int32))
        rows.append(row[ok])
    return np.concatenate(at), np.concatenate(rows)


class Ftrl:
    """FTRL-proximal with a per-coordinate rate; coordinate 2^BITS is the intercept and is not regularised."""

    def __init__(self, alpha: float = 4.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, free = self.z[at], at == 2**BITS
        l1 = np.where(free, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + np.where(free, 0.0, self.l2))
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", *,
    max_train: int = MAX_TRAIN, epochs: int = 3
) -> dict[int, float]:
    """Weights by coordinate, the intercept under 2^BITS; only those that are not zero.

    ``labelled`` has id, text and a 0/1 label; rows with a null label are left out.
    """
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).cast("string").alias("t"),
        F.col(label_col).cast("int").alias("y")
    )

    def learn(batches):
        model, data = Ftrl(), []
        for b in batches:
            for part in slices(b, 1, SLICE_BYTES):
                at, row = features(*T.column_bytes(part.column(1)))
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.arange(len(part) + 1))
                for i, y in enumerate(part.column(2).to_pylist()):
                    data.append((np.append(np.unique(at[order[cut[i] : cut[i + 1]]]), 2**BITS).astype(np.int32), y))
        for _ in range(epochs):
            for at, y in data:
                model.learn(at, y)
        w = model.weights(np.arange(2**BITS + 1))
        keep = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(w[keep])], names=["at", "w"])

    # Sorted by hashes alone, so that whole texts are only moved for the rows taken.
    one = rows.withColumn("k", F.xxhash64("t")).orderBy("h", "k", "y").limit(max_train).drop("k")
    return {
        r["at"]: r["w"] for r in one.repartition(1).sortWithinPartitions("h", "t", "y").mapInArrow(
            learn, "at long, w double"
        ).collect()
    }


def score(docs: DataFrame, weights: dict[int, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each input row: the id and ``score`` in (0, 1), rounded to six places.

    * null and empty texts get the intercept's score; null ids stay null;
    * without any weight (no labels) every score is 0.5;
    * repeated rows are scored each on its own; other columns are ignored.
    """
    base = weights.get(2**BITS, 0.0)
    at = np.array(sorted(k for k in weights if k < 2**BITS), np.int64)
    w = np.array([weights[int(k)] for k in at])

    def apply(batches):
        slot = np.zeros(2**BITS, np.int32)
        slot[at] = np.arange(1, len(at) + 1)
        for b in batches:
            for part in slices(b, 1, SLICE_BYTES):
                got, row = features(*T.column_bytes(part.column(1)))
                k = slot[got]
                hit = np.flatnonzero(k)
                pair = np.unique(row[hit].astype(np.int64) * (len(at) + 1) + k[hit])
                total = np.full(len(part), base)
                if len(pair):
                    total += np.bincount(
                        pair // (len(at) + 1), weights=w[pair % (len(at) + 1) - 1], minlength=len(part)
                    )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.round(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))), 6))],
                    names=[id_col, "score"]
                )

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return src.mapInArrow(apply, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 by 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *,
    threshold: float = 0.7, max_train: int = MAX_TRAIN
) -> DataFrame:
    """Fit on the labelled rows that are not held out, then score all rows.

    Returns the id, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on).

    * at most ``max_train`` labelled rows take part, those with the smallest hashes
      of id, text and label, however often an id repeats in either table;
    * null ids and null labels teach nothing; an id with two labels teaches both;
    * the other columns of both tables are ignored, whatever their names.
    """
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("_i"), F.col(label_col).cast("int").alias("_y"))
    known = known.where(~held_out("_i") & F.col("_i").isNotNull() & F.col("_y").isNotNull()).distinct()
    # At most max_train ids, so the join's build side is bounded.
    some = known.orderBy(F.xxhash64("_i"), "_i", "_y").limit(max_train)
    texts = docs.select(F.col(id_col).alias("_d"), F.col(text_col).cast("string").alias("_t"))
    train = texts.join(F.broadcast(some), texts["_d"] == some["_i"]).select("_i", "_t", "_y")
    weights = fit(train, "_i", "_t", "_y", max_train=max_train)
    out = score(docs, weights, id_col, text_col)
    return out.select(
        id_col, held_out(id_col).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )
