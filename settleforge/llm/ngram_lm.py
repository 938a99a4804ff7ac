"""An interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Counting.  First the words are counted; a word's number is its rank among the sorted
hashes of all words, which workers find in the mapped arrays, so an n-gram is a few
four-byte numbers.  Tasks turn texts into n-grams of the highest order, add up equal
ones and deal them out to shards by hash; each shard is one group of a Spark shuffle,
where an n-gram is one row a slice of texts at most, so frequent ones do not make a
group large.  A shard sums its n-grams and writes them; what it hands on, summed as
well, is the next lower order (each n-gram once: Kneser-Ney counts how many different
words stand before a sequence, not how often it occurs), what follows each context,
and how many n-grams have the counts 1 to 4, which give the discounts.  The number
of shards grows with the corpus, so that a shard holds some ``SHARD_TOKENS``.  With
2^32 words or more their 64-bit hashes take the place of the numbers.

Storage.  A shard is a few files in the shared folder: ascending 64-bit hashes and
their counts, or for contexts their totals and back-off weights.  The top bits of a
hash name its shard.

Scoring.  Workers map those files into memory and look up the sorted distinct
n-grams of many texts at a time, so pages are read in order and shared by all workers
of a machine.  Nothing is broadcast but a dozen numbers and the size of each shard's
vocabulary.  Equal 64-bit hashes of different words or n-grams would share a count;
among 10^9 n-grams an unseen one meets another's hash with probability 5e-11.
"""

from __future__ import annotations

import os
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .packing import slices
from .storage import Scratch, bound_batches

#: Tokens of the corpus for one shard, about.
SHARD_TOKENS = 1 << 21
#: Bytes of text that are scored, and whose n-grams are added up, at a time.
SLICE_BYTES, SUM_BYTES = 8 << 20, 12 << 20
#: Before the first token of a text stands BOS, before that PAD; END is a token.
PAD, BOS, END = (np.uint64(x) for x in range(3))
#: The number of a word that training does not have, and how many numbers are taken.
UNKNOWN, TAKEN = np.uint64(2**32 - 1), 3
#: Discounts where the counts of a tiny corpus give none.
FALLBACK = (0.0, 0.5, 1.0, 1.5)
_SUFFIX, _CONTEXT, _STATS = range(3)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each sequence of words."""
    h = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        h = T.mix(h * _STEP + w)
    return h


def packed(words: list[np.ndarray], wide: bool) -> list[np.ndarray]:
    """Words as columns of long: two numbers in each, or with ``wide`` one hash."""
    if wide:
        return [w.view(np.int64) for w in words]
    two = [*words, *[np.zeros(len(words[0]), np.uint64)] * (len(words) % 2)]
    return [((x << np.uint64(32)) | y).view(np.int64) for x, y in zip(two[::2], two[1::2])]


def unpacked(columns: list[np.ndarray], k: int, wide: bool) -> list[np.ndarray]:
    columns = [c.view(np.uint64) for c in columns]
    if wide:
        return columns
    return [x for c in columns for x in (c >> np.uint64(32), c & np.uint64(2**32 - 1))][:k]


def _columns(k: int, wide: bool) -> list[str]:
    return [f"w{i}" for i in range(k if wide else (k + 1) // 2)]


def _shard(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(h), np.int32)


def token_rows(buf: np.ndarray, off: np.ndarray, order: int):
    """Hashes of all texts' tokens with what stands before them, the tokens' places there, and the n + 1 token offsets."""
    buf = T.LOWER[buf]
    s, e, woff = T.spans(buf, off)
    n, row = len(woff) - 1, T.row_of(woff)
    seq = np.full(len(s) + n * order, PAD, np.uint64)
    at = woff + np.arange(n + 1) * order
    seq[np.arange(len(s)) + row.astype(np.int64) * order + order - 1] = T.hash_spans(buf, s, e)
    if order > 1:
        seq[at[:-1] + order - 2] = BOS
    seq[at[1:] - 1] = END
    token = np.ones(len(seq), bool)
    token[(at[:-1, None] + np.arange(order - 1)).ravel()] = False
    return seq, np.flatnonzero(token), woff + np.arange(n + 1)


def _summed(h: np.ndarray, *values: np.ndarray):
    """First places of the distinct hashes, in their order, and the sums of values."""
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1]))) if len(h) else order
    return order[first], [np.add.reduceat(v[order], first) if len(h) else v for v in values]


def _save(root: str, name: str, shard: int, *columns: np.ndarray) -> None:
    """Files of a shard; a repeated attempt writes the same bytes and replaces them in one step."""
    for i, c in enumerate(columns):
        path = f"{root}/{name}-{shard:08d}.{i}"
        with open(f"{path}.{uuid.uuid4().hex}", "wb") as f:
            c.tofile(f)
        os.replace(f.name, path)


@lru_cache(maxsize=4096)
def _mapped(path: str, kind: str) -> np.ndarray:
    return np.memmap(path, kind, "r") if os.path.exists(path) and os.path.getsize(path) else np.zeros(0, kind)


def _counts(h: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Counts as columns of a shard: one byte each, and hashes and counts of those that have no room in it."""
    large = n > 254
    return [np.where(large, 255, n).astype("u1"), h[large], n[large].astype("<u8")]


class Model:
    """Lookups in the files of a model.

    ``stats`` has, by order, the discounts, the number of n-grams and their totals;
    ``sizes`` the number of words in each shard.
    """

    def __init__(self, root: str, order: int, bits: int, sizes: np.ndarray, tokens: int, wide: bool):
        self.root, self.order, self.bits, self.tokens, self.wide = root, order, bits, tokens, wide
        self.first, self.vocabulary = TAKEN + np.cumsum(sizes) - sizes, int(sizes.sum())
        self.stats: dict[int, dict] = {}

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of hashed words, and their occurrences in training."""
        if self.wide:
            return h, self.find("v", h, "count")[0]
        rank, raw = self.find("v", h, "rank", "count")
        ids = np.where(raw > 0, rank.astype(np.uint64), UNKNOWN)
        return np.where(h < np.uint64(TAKEN), h, ids), raw

    def find(self, name: str, h: np.ndarray, *kinds: str) -> list[np.ndarray]:
        """The columns' values for hashes, 0 where there is none."""
        q, back = np.unique(h, return_inverse=True)
        out = [np.zeros(len(q)) for _ in kinds]
        shards, cut = np.unique(_shard(q, self.bits), return_index=True)
        for shard, i, j in zip(shards.tolist(), cut.tolist(), [*cut[1:].tolist(), len(q)]):
            path = f"{self.root}/{name}-{shard:08d}"
            have = _mapped(f"{path}.0", "<u8")
            if len(have):
                at = np.minimum(np.searchsorted(have, q[i:j]), len(have) - 1)
                hit = have[at] == q[i:j]
                c = 1
                for values, kind in zip(out, kinds):
                    if kind == "rank":
                        values[i:j][hit] = self.first[shard] + at[hit]
                        continue
                    got = _mapped(f"{path}.{c}", "u1" if kind == "count" else kind)[at[hit]]
                    if kind == "count":
                        more = np.flatnonzero(got == 255)
                        got = got.astype(np.float64)
                        if len(more):
                            place = np.searchsorted(_mapped(f"{path}.{c + 1}", "<u8"), q[i:j][hit][more])
                            got[more] = _mapped(f"{path}.{c + 2}", "<u8")[place]
                        c += 2
                    values[i:j][hit] = got
                    c += 1
        return [v[back] for v in out]

    def score(self, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each token in training, and its probability."""
        seq, raw = self.words(seq)
        one = self.stats[1]
        (adjusted,) = self.find("n1", gram_hash([seq[at]]), "count")
        p = np.full(len(at), 1.0 / (self.vocabulary + 1))
        if one["adjusted"]:
            d = np.array(one["discounts"])
            p = (adjusted - d[np.minimum(adjusted, 3).astype(int)]) / one["adjusted"] + one["left"] * p
        for k in range(2, self.order + 1):
            words = [seq[at - j] for j in range(k - 1, -1, -1)]
            total, left = self.find(f"c{k}", gram_hash(words[:-1]), "<f8", "<f8")
            (n,) = self.find(f"n{k}", gram_hash(words), "count")
            d = np.array(self.stats[k]["discounts"])
            known = total > 0
            p[known] = (n - d[np.minimum(n, 3).astype(int)])[known] / total[known] + left[known] * p[known]
        return raw[at], p


def _gathered(batches):
    """The texts of batches, in columns of about ``SUM_BYTES``: the more texts, the more equal n-grams are added up at once."""
    some, size = [], 0
    for b in batches:
        for part in slices(b, 0, SUM_BYTES):
            some.append(part.column(0))
            size += int(T.column_bytes(part.column(0))[1][-1])
            if size >= SUM_BYTES:
                yield pa.chunked_array(some)
                some, size = [], 0
    if some:
        yield pa.chunked_array(some)


def _emit_words(bits: int):
    """Texts to (shard, word's hash, n)."""

    def emit(batches):
        for column in _gathered(batches):
            seq, _, _ = token_rows(*T.column_bytes(column), 1)
            h, n = np.unique(seq, return_counts=True)
            cols = [pa.array(_shard(h, bits)), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["shard", "w0", "n"])
        T.release()

    return emit


def _store_words(root: str):
    def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        h = table.column("w0").to_numpy().view(np.uint64)
        first, (n,) = _summed(h, table.column("n").to_numpy())
        h = h[first]
        _save(root, "v", key[0].as_py(), h, *_counts(h, n))
        T.release()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "words": [len(h)], "tokens": [int(n.sum())]})

    return store


def _emit(model: Model):
    """Texts to (shard, words, n), equal n-grams of a slice added up."""
    order = model.order

    def emit(batches):
        for column in _gathered(batches):
            seq, at, _ = token_rows(*T.column_bytes(column), order)
            seq, _ = model.words(seq)
            words = [seq[at - j] for j in range(order - 1, -1, -1)]
            h = gram_hash(words)
            first, (n,) = _summed(h, np.ones(len(h), np.int64))
            cols = [pa.array(_shard(h[first], model.bits)), *map(pa.array, packed([w[first] for w in words], model.wide)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(cols, names=["shard", *_columns(order, model.wide), "n"])
            del seq, at, words, h, first, n, cols
        T.release()

    return emit


def _store(root: str, k: int, bits: int, wide: bool):
    """A shard's n-grams of order ``k``: written, and summed for what comes next."""

    def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words = unpacked([table.column(c).to_numpy() for c in _columns(k, wide)], k, wide)
        h = gram_hash(words)
        first, (n,) = _summed(h, table.column("n").to_numpy())
        h, words = h[first], [w[first] for w in words]
        # Sequences that reach beyond the start of a text are of a lower order; they occur as often as they are counted.
        real = words[0] != PAD
        a = n[real]
        _save(root, f"n{k}", key[0].as_py(), h[real], *_counts(h[real], a))
        parts, names = [], _part_names(k, wide)

        def add(kind, shard, columns, *values):
            size, more = len(shard), len(names) - 8 - len(columns)
            columns = [*columns, *[np.zeros(size, np.int64)] * more]
            values = [*values, *[np.zeros(size, np.int64)] * (6 - len(values))]
            cols = [np.full(size, kind, np.int32), shard, *columns, *[v.astype(np.int64) for v in values]]
            parts.append(pa.Table.from_arrays([pa.array(c) for c in cols], names=names))

        if k > 1:
            hs = gram_hash(words[1:])
            at, (d,) = _summed(hs, np.where(real, 1, n))
            add(_SUFFIX, _shard(hs[at], bits), packed([w[at] for w in words[1:]], wide), d)
            hc = gram_hash([w[real] for w in words[:-1]])
            at, sums = _summed(hc, a, *[(a == i).astype(np.int64) for i in (1, 2)], (a > 2).astype(np.int64))
            add(_CONTEXT, _shard(hc[at], bits), [hc[at].view(np.int64)], *sums)
        sums = [*[(a == i).sum() for i in (1, 2, 3, 4)], len(a), a.sum()]
        add(_STATS, np.zeros(1, np.int32), [], *[np.array([x], np.int64) for x in sums])
        del words, first, h, n, a, table
        T.release()
        return pa.concat_tables(parts)

    return store


def _part_names(k: int, wide: bool) -> list[str]:
    return ["kind", "shard", *_columns(max(k - 1, 1), wide), *[f"v{i}" for i in range(6)]]


def _contexts(root: str, k: int, discounts: list[float]):
    """A shard's contexts of order ``k``: totals, and the weight that is left for the lower order."""

    def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        h = table.column("w0").to_numpy().view(np.uint64)
        first, (total, *n) = _summed(h, *[table.column(f"v{i}").to_numpy() for i in range(4)])
        left = sum(d * x for d, x in zip(discounts[1:], n)) / total
        _save(root, f"c{k}", key[0].as_py(), h[first], total.astype("<f8"), left.astype("<f8"))
        return pa.table({"n": pa.array([len(first)], pa.int64())})

    return store


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Of counts 0, 1, 2 and more; ``FALLBACK`` where numbers of n-grams with these counts do not give them."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 < d[i] <= i for i in (1, 2, 3)):
            return d
    return list(FALLBACK)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the model does not learn from: crc32 of the id as text leaves 1 by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def train(texts: DataFrame, order: int, *, shard_tokens: int = SHARD_TOKENS, wide: bool | None = None) -> Model:
    """Count the one column of ``texts`` and write the model into the shared folder, where it stays until the driver ends.

    ``wide``: words by hash and not by number, which by default is done where there are too many for four bytes.
    """
    scratch = Scratch(texts.sparkSession)
    root = scratch.root.removeprefix("file://").removeprefix("file:")
    if "://" in root:
        raise ValueError("workers map the model's files, so spark.checkpoint.dir must be a mounted folder (file:)")
    (col,) = texts.columns
    size = texts.agg(F.sum(F.octet_length(F.col(col)))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, size / 6 / shard_tokens)))))
    root = f"{root}/model"
    os.makedirs(root, exist_ok=True)
    words = texts.mapInArrow(_emit_words(bits), "shard int, w0 long, n long").groupBy("shard")
    words = words.applyInArrow(_store_words(root), "shard int, words long, tokens long")
    sizes, tokens = np.zeros(1 << bits, np.int64), 0
    for r in scratch.write(words, "words").collect():  # one row a shard
        sizes[r["shard"]], tokens = r["words"], tokens + r["tokens"]
    if wide is None:
        wide = int(sizes.sum()) + TAKEN >= int(UNKNOWN)
    model = Model(root, order, bits, sizes, tokens, wide)
    long = lambda names: ", ".join(f"{n} long" for n in names)
    rows = texts.mapInArrow(_emit(model), f"shard int, {long([*_columns(order, wide), 'n'])}")
    for k in range(order, 0, -1):
        made = rows.groupBy("shard").applyInArrow(
            _store(root, k, bits, wide), f"kind int, shard int, {long(_part_names(k, wide)[2:])}"
        )
        parts, made = scratch.write(made, f"order{k}"), None
        scratch.tidy()
        sums = parts.where(F.col("kind") == _STATS).agg(*[F.sum(f"v{i}") for i in range(6)]).first()
        n = [x or 0 for x in sums]
        d = discounts(*n[:4])
        model.stats[k] = {"discounts": d, "grams": n[4], "adjusted": n[5]}
        scratch.tidy()
        if k == 1:
            more = n[4] - n[0] - n[1]
            model.stats[1]["left"] = (d[1] * n[0] + d[2] * n[1] + d[3] * more) / n[5] if n[5] else 1.0
            return model
        mine = parts.where(F.col("kind") == _CONTEXT).select("shard", "w0", *[f"v{i}" for i in range(4)])
        mine.groupBy("shard").applyInArrow(_contexts(root, k, d), "n long").agg(F.sum("n")).collect()
        rows = parts.where(F.col("kind") == _SUFFIX).select("shard", *_columns(k - 1, wide), F.col("v0").alias("n"))


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, order: int = 2, shard_tokens: int = SHARD_TOKENS,
    wide: bool | None = None
) -> DataFrame:
    """Log10 probabilities of whole texts under the model of the texts that are not held out.

    Returns the id, held_out, n_tokens, n_known (tokens seen in training),
    train_tokens, base_score (unigrams with 0.5 added to each count) and score (the
    model's).  Tokens are lower-cased words and one end a text.

    * null and empty texts are one token, the end; a null id is not held out;
    * repeated rows count and score each on their own; texts may be of any length;
    * without training texts every token has probability 1 / 1;
    * other columns are ignored, whatever their names.
    """
    bound_batches(docs.sparkSession)
    src = docs.select(
        F.col(id_col).alias("_i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"),
        held_out(id_col).alias("_h")
    )
    model = train(src.where(~F.col("_h")).select("_t"), order, shard_tokens=shard_tokens, wide=wide)
    tokens, grams = model.tokens, model.vocabulary

    def apply(batches):
        for b in batches:
            for part in slices(b, 1, SLICE_BYTES):
                seq, at, off = token_rows(*T.column_bytes(part.column(1)), order)
                raw, p = model.score(seq, at)
                base = np.log10((raw + 0.5) / (tokens + 0.5 * (grams + 1)))
                sums = [np.add.reduceat(x, off[:-1]) for x in (base, np.log10(p), (raw > 0).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), pa.array(np.diff(off)), pa.array(sums[2]),
                        pa.array(np.full(len(part), tokens, np.int64)), pa.array(sums[0]), pa.array(sums[1])
                    ],
                    names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                )
                del seq, at, raw, p, base
        T.release()

    kind = docs.schema[id_col].dataType.simpleString()
    return src.mapInArrow(
        apply, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
