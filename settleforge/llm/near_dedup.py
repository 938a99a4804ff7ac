"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

A document is the set of its distinct five-word shingles.  Documents with equal
sets are one node.  Nodes that share a band of MinHash values are candidates; an
odd sketch (the MinHash samples folded into a parity bitmap) estimates a pair's
similarity from the population count of the XOR, far cheaper than the sets.  A
second parity bitmap, of the whole set and of a size that follows it, bounds the
similarity: an element that only one set has flips one bit, so the sets differ in
at least as many elements as the XOR has bits, and a pair that the bound puts
below the threshold is no link for certain.  What passes both is confirmed on
full sets and becomes a link.

No bucket is ever expanded into all its pairs, and linked nodes are contracted as
soon as they are found, so each round sees fewer components than the one before:

1. every node is tried with one other, the smallest id in all its buckets;
2. in buckets that span several components, each component there is tried with
   the bucket's smallest one, one pair of members for each pair of components;
3. in buckets that span several components even then, the members outside the
   bucket's largest component are compared with all others by their bitmaps, in
   blocks of bounded size, and each is tried with its nearest, again while that
   finds links;
4. at last every remaining pair across components that the bitmaps allow is tried.

Buckets that lie in one component drop out for good.  Pairs inside a component
need no trial, so nothing is lost: after step 4 each candidate pair is linked,
confirmed unlinked, or already in one component.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops as T
from .packing import slices
from .storage import Scratch, bound_batches

SHINGLE = 5
#: 32 bands of 4 values: a pair at similarity 0.75 is missed with probability (1 - 0.75^4)^32, about 5e-6.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Sketches that estimate less are not confirmed; more than four standard deviations below 0.75.
SKETCH_SIMILARITY = 0.55
#: Partners that a document's set is held against in one task.
PARTNERS = 256
#: Members compared with each other in one task.
CHUNK = 512
#: Times that steps 2 and 3 run at most; what they leave is step 4's.
HEAD_ROUNDS, NEAREST_ROUNDS = 1, 3
#: Ids that are sent to every task to pick texts by (8 bytes each); more are joined by shuffling.
BROADCAST_IDS = 1_000_000
SLICE_BYTES = 2 << 20

_RNG = np.random.default_rng(7_052_023)
_A = _RNG.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32)


def shingles(buf: np.ndarray, off: np.ndarray, width: int = SHINGLE, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's shingles, repeats included, and the n + 1 offsets of the rows.

    A-Z are lower-cased; a row of fewer than ``width`` words has its whole word
    sequence as one shingle, a row without words has none.
    """
    buf = T.LOWER[buf]
    s, e, woff = T.spans(buf, off)
    words, count = T.hash_spans(buf, s, e, seed), np.diff(woff)
    row = T.row_of(woff)
    all_ = T.fold(words, width, (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)[seed])
    ok = row[: len(all_)] == row[width - 1 :] if len(all_) else np.zeros(0, bool)
    size = np.maximum(count - width + 1, 0)
    short = np.flatnonzero((count > 0) & (count < width))
    size[short] = 1
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(at[-1], np.uint64)
    fill = np.ones(at[-1], bool)
    fill[at[short]] = False
    out[fill] = all_[ok]
    for d in short:
        h = np.full(1, 0x589965CC75374CC3 + int(count[d]), np.uint64)
        for w in words[woff[d] : woff[d + 1]]:
            h = T.mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
        out[at[d]] = h[0]
    return out, at


def _sign(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty sets, a row each."""
    out = np.empty((len(sets), SAMPLES), np.uint32)
    for i, u in enumerate(sets):
        x = (u >> np.uint64(32)).astype(np.uint32)
        best = None
        for k in range(0, len(x), 2048):
            y = x[k : k + 2048, None] * _A + _B
            y ^= y >> np.uint32(15)
            y = y.min(axis=0)
            best = y if best is None else np.minimum(best, y)
        out[i] = best
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(mins), BANDS)).copy()
    v = mins.reshape(len(mins), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        h = T.mix(h * np.uint64(0x9E3779B97F4A7C15) + v[:, :, r])
    return h.view(np.int64)


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples (i, value): SKETCH_BITS / 64 words a row."""
    h = T.mix(mins.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))
    at = (h % np.uint64(SKETCH_BITS)).astype(np.int64) + np.arange(len(mins))[:, None] * SKETCH_BITS
    odd = (np.bincount(at.ravel(), minlength=len(mins) * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(mins), SKETCH_BITS), axis=1).view(np.int64)


def parity(u: np.ndarray) -> bytes:
    """Parity bitmap of a whole set: a power of two of bits, 64 at least and twice the set's size at least."""
    n = 1 << max(6, (2 * len(u) - 1).bit_length())
    odd = np.bincount((T.mix(u) & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (of words, in the last axis) halved until they have ``size`` words: bits whose places agree then cancel."""
    while bitmap.shape[-1] > size:
        half = bitmap.shape[-1] // 2
        bitmap = bitmap[..., :half] ^ bitmap[..., half:]
    return bitmap


def allowed(flips: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of the given summed sizes can meet the threshold when they differ in ``flips`` elements at least."""
    return 100 * (sizes - flips) >= percent * (sizes + flips)


def most_flips(similarity: float) -> int:
    """The XOR population count that a pair of this similarity is expected to have.

    The samples of two sets differ in about 2 * SAMPLES * (1 - J) elements, each
    of which flips one bit at random.
    """
    apart = 2 * SAMPLES * (1 - similarity)
    return math.floor(SKETCH_BITS / 2 * (1 - math.exp(-2 * apart / SKETCH_BITS)))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, and of non-empty sets: digest, bands, sketch, parity."""

    def sign(batches):
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                sh, at = shingles(*T.column_bytes(part.column(1)))
                sets = [np.unique(sh[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                size = np.array([len(u) for u in sets], np.int64)
                some = np.flatnonzero(size)
                mins = _sign([sets[i] for i in some])
                digest: list = [None] * len(sets)
                bands, sketch, whole = list(digest), list(digest), list(digest)
                for i, k, s in zip(some.tolist(), band_keys(mins), odd_sketches(mins), strict=True):
                    digest[i], bands[i], sketch[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), k, s
                    whole[i] = parity(sets[i])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(size), pa.array(digest, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64())),
                        pa.array(whole, pa.binary())
                    ],
                    names=["id", "n_shingles", "digest", "bands", "sketch", "parity"]
                )
        T.release()

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(
        sign, "id long, n_shingles long, digest binary, bands array<long>, sketch array<long>, parity binary"
    )


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that odd sketches put near enough and whole parities allow."""

    def check(batches):
        for batch in batches:
            n, a, b = batch.column(2).to_numpy(), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            flips = np.empty(len(batch), np.int64)
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                k = min(len(x), len(y))
                flips[i] = np.bitwise_count(folded(x, k) ^ folded(y, k)).sum()
            at = pa.array(np.flatnonzero(allowed(flips, n, percent)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])
        T.release()

    flips = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))

    def side(x: str) -> DataFrame:
        return nodes.select(
            F.col("id").alias(x), F.col("sketch").alias(f"s{x}"), F.col("parity").alias(f"p{x}"),
            F.col("n_shingles").alias(f"n{x}")
        )

    both = pairs.join(side("b"), "b").join(side("a"), "a").where(flips <= most_flips(SKETCH_SIMILARITY))
    return both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "pa", "pb").mapInArrow(check, "a long, b long")


def _meets(u: tuple[np.ndarray, np.ndarray], v: tuple[np.ndarray, np.ndarray], percent: int) -> bool:
    """Whether two sets, each sorted by a first hash and with a second one beside it, meet the threshold."""
    _, i, j = np.intersect1d(u[0], v[0], assume_unique=True, return_indices=True)
    both = int((u[1][i] == v[1][j]).sum())
    return both > 0 and 100 * both >= percent * (len(u[0]) + len(v[0]) - both)


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int = 75) -> DataFrame:
    """The pairs (a, b) whose full shingle sets meet 100 * intersection >= percent * union.  ``pairs`` is read three times.

    The smaller id of a pair is often a hub.  Its text is no column beside its
    partners' texts: it comes once, ahead of them, and its set is kept while they pass.
    A hub of more than ``PARTNERS`` is dealt out, its text to each of its parts.
    """

    def sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        data = T.column_bytes(column)
        (x, at), (y, _) = shingles(*data), shingles(*data, seed=1)
        out = []
        for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            u, first = np.unique(x[i:j], return_index=True)
            out.append((u, y[i:j][first]))
        return out

    def check(batches):
        hub, texts = None, []
        for batch in batches:
            for part in slices(batch, 3, SLICE_BYTES):
                own, keep = sets(part.column(3)), np.zeros(len(part), bool)
                ids = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
                for i, (a, salt, b) in enumerate(ids):
                    if (a, salt) != hub:
                        hub, texts = (a, salt), []
                    if b is None:
                        texts.append(own[i])  # rows of one id may hold several texts
                    else:
                        keep[i] = any(_meets(x, own[i], percent) for x in texts)
                at = pa.array(np.flatnonzero(keep))
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at)], names=["a", "b"])
        T.release()

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    ).join(ids, "id", "left_semi")
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    hubs = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    hubs = hubs.join(texts.withColumnRenamed("id", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("salt"))
    dealt = dealt.join(texts.withColumnRenamed("id", "b"), "b").select("a", "salt", "b", "text")
    rows = hubs.unionByName(dealt).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(check, "a long, b long").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node that has an edge (a, b).

    Each round takes the smallest label among neighbours, then the label's own
    label; the rounds grow with the logarithm of a component's diameter.  Only
    counts come to the driver.
    """
    both = edges.where("a <> b").select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
            )
        ).alias("e")
    )
    both = scratch.write(both.select("e.u", "e.v").distinct(), "edges")
    labels = scratch.write(
        both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("node"), F.least("u", "m").alias("component")
        ),
        "labels"
    )
    while True:
        near = both.join(
            labels.select(F.col("node").alias("v"), "component"), "v"
        ).groupBy("u").agg(F.min("component").alias("m"))
        step = labels.join(near, labels["node"] == near["u"]).select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("mid")
        )
        up = labels.select(F.col("node").alias("mid"), F.col("component").alias("top"))
        new = scratch.write(
            step.join(up, "mid").select(
                "node", F.least("mid", "top").alias("component"), (F.least("mid", "top") < F.col("old")).alias("moved")
            ),
            "labels"
        )
        done = new.where("moved").isEmpty()
        scratch.drop(labels)
        labels = new
        if done:
            scratch.drop(both)
            return labels.select("node", "component")


def contracted(links: DataFrame, labels: DataFrame | None, scratch: Scratch) -> DataFrame:
    """``labels`` (node, component) after the links (a, b) between nodes have joined their components."""
    if labels is None:
        return components(links, scratch)
    end = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    ends = links.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
    )
    up = components(ends.distinct(), scratch)
    moved = labels.join(
        up.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left"
    ).select("node", F.coalesce("top", "component").alias("component"))
    return scratch.write(moved.unionByName(up.join(labels, "node", "left_anti")), "labels")


def _across(members: DataFrame, nearest: bool, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of members of one bucket in different components that both bitmaps allow.

    ``members``: key, main, n_main, n_rest, id, component, sketch, parity,
    n_shingles.  The members of a bucket's largest component (``main``) are not
    compared with each other.  All are dealt out in chunks, and each pair of chunks
    is compared in a task of its own.  ``nearest``: of each member's pairs only the nearest.
    """
    limit, none = most_flips(SKETCH_SIMILARITY), 1 << 40

    def compare(key, table):
        ids, comp, size, side = (table[c].to_numpy() for c in ("id", "component", "n_shingles", "side"))
        sketch = np.array(table["sketch"].to_pylist(), np.int64).view(np.uint64)
        left, right = np.flatnonzero(side == key[1].as_py()), np.flatnonzero(side == key[2].as_py())
        flips = np.bitwise_count(sketch[left][:, None, :] ^ sketch[right][None, :, :]).sum(axis=2, dtype=np.int64)
        i, j = np.nonzero((flips <= limit) & (comp[left][:, None] != comp[right][None, :]))
        i, j = left[i], right[j]
        whole = [np.frombuffer(x, np.uint64) for x in table["parity"].to_pylist()]
        words = np.array([len(x) for x in whole])
        apart = np.full(len(i), none)
        for n in np.unique(words):
            at = np.flatnonzero(np.minimum(words[i], words[j]) == n)
            have = np.flatnonzero(words >= n)
            place = np.zeros(len(words), np.int64)
            place[have] = np.arange(len(have))
            rows = np.stack([folded(whole[k], n) for k in have])
            step = max(1, (4 << 20) // (8 * int(n)))
            for k in range(0, len(at), step):
                some = at[k : k + step]
                apart[some] = np.bitwise_count(rows[place[i[some]]] ^ rows[place[j[some]]]).sum(axis=1, dtype=np.int64)
        ok = allowed(apart, size[i] + size[j], percent)
        i, j, apart = i[ok], j[ok], apart[ok]
        if nearest and len(i):
            keep = np.zeros(len(i), bool)
            for me in (i, j):
                order = np.lexsort((apart, me))
                keep[order[np.concatenate(([True], me[order][1:] != me[order][:-1]))]] = True
            i, j = i[keep], j[keep]
        a, b = ids[i], ids[j]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    chunks = lambda n: F.ceil(F.col(n) / CHUNK).cast("int")
    rest, mine = chunks("n_rest"), F.col("component") == F.col("main")
    side = F.when(
        mine, rest + F.pmod(F.xxhash64("id"), chunks("n_main"))
    ).otherwise(F.pmod(F.xxhash64("id"), rest)).cast("int")
    last = F.when(mine, rest).otherwise(rest + chunks("n_main")) - 1
    dealt = members.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.select(
        "key", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "id", "component",
        "sketch", "parity", "n_shingles"
    )
    return dealt.groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def _components_of(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, id) with their component."""
    own = members.join(labels.withColumnRenamed("node", "id"), "id", "left")
    return own.select("key", "id", F.coalesce("component", "id").alias("component"))


def _split(own: DataFrame) -> DataFrame:
    """A row for each component of each bucket that spans several: key, component, its smallest id there, n, sums over its members, and the bucket's smallest component (top)."""
    sums = [F.sum(F.xxhash64("id") % 2**40).alias("s"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("x")]
    each = own.groupBy("key", "component").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), *sums)
    bucket = Window.partitionBy("key")
    both = each.withColumn(
        "top", F.min(F.struct("component", "least")).over(bucket)
    ).withColumn("high", F.max("component").over(bucket))
    return both.where(F.col("top.component") < F.col("high")).drop("high")


def _unsettled(own: DataFrame, split: DataFrame) -> DataFrame:
    """Members of split buckets with what ``_across`` needs; of buckets with the same members one is enough."""
    sums = split.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all"), F.sum("s").alias("s"),
        F.bit_xor("x").alias("x")
    )
    one = sums.groupBy("all", "s", "x").agg(F.min(F.struct("key", "m")).alias("k"))
    one = one.select(
        "k.key", F.col("k.m.component").alias("main"), F.col("k.m.n").alias("n_main"),
        (F.col("all") - F.col("k.m.n")).alias("n_rest")
    )
    return own.join(one, "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 75) -> DataFrame:
    """Link documents whose shingle sets meet 100 * intersection >= percent * union, and label components.

    Returns a row for each input row: the id (long), ``n_shingles``,
    ``component_id`` (the smallest id reachable, itself included) and ``kept``
    (the id is its component's).

    * null and empty texts and texts without words have no shingles and link with nothing;
    * a null id links with nothing: its component is null and it is kept;
    * rows with one id are one node, linked by whatever any of them links with;
    * equal texts always link; an empty table gives no rows;
    * other columns are ignored; texts of any length count whole.
    """
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark)
    sig = scratch.write(signatures(docs, id_col, text_col), "signatures")
    sets = sig.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    heads = scratch.write(sets.groupBy("digest").agg(F.min("id").alias("head")), "heads")
    nodes = sets.join(
        heads.withColumnRenamed("head", "id"), ["digest", "id"], "left_semi"
    ).dropDuplicates(["digest", "id"])
    nodes = scratch.write(nodes.drop("digest"), "nodes")

    banded = nodes.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    members = scratch.write(banded.join(buckets, "key").select("key", "id", "head").distinct(), "members")
    first = members.groupBy("id").agg(F.min("head").alias("a")).where("a < id").select("a", F.col("id").alias("b"))
    tried = scratch.write(_near(first, nodes, percent), "pairs")
    # An id that stands for several sets ties their nodes together.
    own = sets.select("digest", "id").join(
        sets.groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo < hi"), "id",
        "left_semi"
    ).join(heads, "digest")
    ties = own.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).where("a < b").distinct()
    links = scratch.write(confirm(tried, docs, id_col, text_col, percent).unionByName(ties), "links")
    labels = contracted(links, None, scratch)
    scratch.tidy()

    members, left, useless = members.drop("head"), None, None
    for step in ["head"] * HEAD_ROUNDS + ["nearest"] * NEAREST_ROUNDS + ["all"]:
        if step == useless:
            continue
        if step == "head":
            split = _split(_components_of(members, labels)).where(F.col("component") > F.col("top.component"))
            more = split.groupBy("top.component", "component").agg(
                F.min(F.struct(F.col("top.least").alias("a"), F.col("least").alias("b"))).alias("p")
            )
            more = more.select(F.least("p.a", "p.b").alias("a"), F.greatest("p.a", "p.b").alias("b")).distinct()
            more = _near(more.join(tried, ["a", "b"], "left_anti"), nodes, percent)
        else:
            if left is None:  # nothing has been linked since where it is not
                own = scratch.write(_components_of(members, labels), "own")
                left = scratch.write(_unsettled(own, _split(own)), "members")
                members = left.select("key", "id")
            more = _across(
                left.join(nodes.drop("bands"), "id"), step == "nearest", percent
            ).join(tried, ["a", "b"], "left_anti")
        more = scratch.write(more, "pairs")
        found = None if more.isEmpty() else scratch.write(confirm(more, docs, id_col, text_col, percent), "links")
        useless = step if found is None or found.isEmpty() else None
        if not useless:
            labels, left = contracted(found, labels, scratch), None
        tried = tried.unionByName(more)
        scratch.tidy()
    top = heads.join(labels.withColumnRenamed("node", "head"), "head", "left").select(
        "digest", F.coalesce("component", "head").alias("component")
    )
    out = sig.select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest")
    ).join(top, "digest", "left")
    out = out.select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    return out.select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def oracle(table: str = "documents", percent: int = 75) -> str:
    """The same components in SQL, from every pair of documents that share a shingle."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM {table}),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < {SHINGLE} THEN w ELSE w[i:i + {SHINGLE - 1}] END, ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= {percent} * (x.n + y.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, w.doc_id = c.c AS kept FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.doc_id = w.doc_id"""
