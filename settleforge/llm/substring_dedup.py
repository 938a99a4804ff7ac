"""Substring dedup by recompression.

A word sequence is compressed in rounds.  Each round first names every maximal
run of one symbol, then splits the alphabet into left and right symbols and
names every left-right pair.  A name is a 64-bit fingerprint of what it stands
for, so a round needs no dictionary and names agree over the whole corpus: equal
substrings get the same symbols in their interior whatever document they are in.
Beside each symbol goes the word interval that its parse depends on; a symbol is
*safe* for a window when that interval lies inside the window, and every other
occurrence of the window then holds the same symbol at the same place.

Spark runs five steps over blocks of documents, dealt by a hash of id and text:

1. each block recompresses its words and sends its distinct safe symbols, dealt
   by fingerprint, so a symbol counts once per block however often it occurs;
2. each bucket answers, one bit a symbol, whether the symbol occurs elsewhere;
3. shared symbols reveal where repeats can be: a window that holds a safe symbol
   which nothing else has occurs once and is dropped; the blocks send two
   independent 64-bit hashes of each of the few windows left, and where it stands first;
4. each bucket answers, one bit a window, whether an earlier document has it;
5. the blocks unite the repeated windows and keep the other words.

Dropping in step 3 is exact, by the argument above; a window without any safe
symbol (a long run of one word, say) stays in and is settled by step 4.  No step
gathers a group: a passage that stands in every document costs one hash a block.
Blocks need no order and no quantiles of the ids: a window carries the place (id,
hash of the text) of its first occurrence, and places decide what is earlier.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .storage import bound_batches

#: Text bytes of a block; what a Python worker holds is a small multiple of this.
BLOCK_BYTES = 8 << 20
#: Hashes that a bucket is expected to get.
BUCKET_HASHES = 1 << 21
#: Rounds; symbols of later ones reach over more words than a window of 20 has, and so are safe for none.
ROUNDS = 4
#: Symbols of fewer words are common and drop no window; leaving them out is safe.
LEAST_WORDS = 2
_FAR = 1 << 30
_LEAST = -(2**63)
#: Where a document stands among all: by id, rows of one id by a hash of their text.
_PLACE = np.dtype([("id", "<i8"), ("row", "<i8")])
_WINDOW = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("place", _PLACE)])
_M1, _M2 = 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25


def recompress(words: np.ndarray, row: np.ndarray, rounds: int = ROUNDS):
    """Symbols of the last round: name, first word, end, and the interval [lo, hi) that the parse depends on.

    ``row`` holds each word's document; nothing is named across documents, and a
    symbol whose parse depends on a document's edge gets an interval that no
    window contains.
    """
    n = len(words)
    sym, d = words, row
    s = np.arange(n, dtype=np.int32)
    e, lo, hi = s + 1, s.copy(), s + 1
    for t in range(rounds):
        if len(sym) < 2:
            break
        # Runs.
        head = np.ones(len(sym), dtype=bool)
        head[1:] = (sym[1:] != sym[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(head)
        if len(at) < len(sym):
            last = np.append(at[1:], len(sym)) - 1
            k = (last - at + 1).astype(np.uint64)
            named = T.mix(sym[at] * np.uint64(0xA0761D6478BD642F) + k)
            sym = np.where(k > 1, named, sym[at])
            lo, hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            s, e, d = s[at], e[last], d[at]
        # A run ends where its neighbour differs.  A different outer word shows that; else the neighbour's own parse must be known.
        joined = d[1:] == d[:-1]
        lo2, hi2 = lo.copy(), hi.copy()
        easy = words[np.maximum(s[1:] - 1, 0)] != words[e[1:] - 1]
        lo2[1:] = np.where(joined, np.minimum(lo[1:], np.where(easy, s[1:] - 1, lo[:-1])), -_FAR)
        hi2[1:] = np.where(joined & ~easy, np.maximum(hi2[1:], hi[:-1]), hi2[1:])
        easy = words[np.minimum(e[:-1], n - 1)] != words[s[:-1]]
        hi2[:-1] = np.where(joined, np.maximum(hi2[:-1], np.where(easy, e[:-1] + 1, hi[1:])), _FAR)
        lo2[:-1] = np.where(joined & ~easy, np.minimum(lo2[:-1], lo[1:]), lo2[:-1])
        lo2[0], hi2[-1] = -_FAR, _FAR
        lo, hi = lo2, hi2
        # Pairs.
        left = (T.mix(sym ^ np.uint64((0xE7037ED1A0B428DB * (t + 1)) % 2**64)) & np.uint64(1)) == 0
        pair = np.zeros(len(sym), dtype=bool)
        pair[:-1] = left[:-1] & ~left[1:] & joined
        tail = np.zeros(len(sym), dtype=bool)
        tail[1:] = pair[:-1]
        lo2, hi2 = lo.copy(), hi.copy()
        wait = np.flatnonzero(left & ~pair)
        near = np.minimum(wait + 1, len(sym) - 1)
        known = (near > wait) & (d[near] == d[wait])
        lo2[wait] = np.where(known, np.minimum(lo[wait], lo[near]), -_FAR)
        hi2[wait] = np.where(known, np.maximum(hi[wait], hi[near]), _FAR)
        wait = np.flatnonzero(~left & ~tail)
        near = np.maximum(wait - 1, 0)
        known = (near < wait) & (d[near] == d[wait])
        lo2[wait] = np.where(known, np.minimum(lo[wait], lo[near]), -_FAR)
        hi2[wait] = np.where(known, np.maximum(hi[wait], hi[near]), _FAR)
        at = np.flatnonzero(pair)
        lo2[at], hi2[at] = np.minimum(lo[at], lo[at + 1]), np.maximum(hi[at], hi[at + 1])
        sym, e = sym.copy(), e.copy()
        sym[at] = T.mix(sym[at] * np.uint64(0x8EBC6AF09C88C6E3) + T.mix(sym[at + 1] + np.uint64(0x589965CC75374CC3)))
        e[at] = e[at + 1]
        keep = ~tail
        sym, s, e, lo, hi, d = sym[keep], s[keep], e[keep], lo2[keep], hi2[keep], d[keep]
    return sym, s, e, lo, hi


class _Block:
    """A block's documents in order, its words, and what is derived from them the same way in every step."""

    def __init__(self, table: pa.Table, width: int, rounds: int):
        self.width = width
        self.table = table.sort_by([("id", "ascending"), ("row", "ascending")])
        nulls = self.table["id"].null_count
        if nulls:  # they sort last; here they come first
            self.table = pa.concat_tables(
                [self.table.slice(len(self.table) - nulls), self.table.slice(0, len(self.table) - nulls)]
            )
        self.buf, self.off = T.column_bytes(self.table["text"])
        self.starts, self.ends, self.woff = T.spans(self.buf, self.off)
        self.words = T.hash_spans(self.buf, self.starts, self.ends)
        self.row = T.row_of(self.woff)
        self.places = np.zeros(len(self.table), _PLACE)
        self.places["id"] = self.table["id"].fill_null(_LEAST).to_numpy()
        self.places["row"] = self.table["row"].to_numpy()
        if not rounds:
            return
        sym, s, e, lo, hi = recompress(self.words, self.row, rounds)
        use = (hi.astype(np.int64) - lo <= width) & (e - s >= LEAST_WORDS)
        self.sym, self.lo, self.hi = sym[use], lo[use].astype(np.int64), hi[use].astype(np.int64)
        self.names, self.which, times = np.unique(self.sym, return_inverse=True, return_counts=True)
        self.again = times > 1

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold no unshared safe symbol."""
        n, w = len(self.words), self.width
        if n < w:
            return np.zeros(0, np.int64)
        alone = ~shared[self.which]
        d = np.bincount(
            np.maximum(self.hi[alone] - w, 0), minlength=n + 2
        ) - np.bincount(self.lo[alone] + 1, minlength=n + 2)
        open_ = np.cumsum(d[: n - w + 1]) <= 0
        open_ &= self.row[: n - w + 1] == self.row[w - 1 :]
        return np.flatnonzero(open_)

    def windows(self, at: np.ndarray):
        """The distinct windows at ``at`` in order (hashes, place of the first one), which of them each is, and whether it is the first."""
        other = T.hash_spans(self.buf, self.starts, self.ends, seed=1)
        h1, h2 = T.fold(self.words, self.width, _M1)[at], T.fold(other, self.width, _M2)[at]
        order = np.lexsort((h2, h1))  # stable: equal windows stay in text order
        a, b = h1[order], h2[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        which, first = np.empty(len(a), np.int64), np.zeros(len(a), bool)
        which[order] = np.cumsum(new) - 1
        first[order[new]] = True
        out = np.zeros(int(new.sum()), _WINDOW)
        out["h1"], out["h2"], out["place"] = a[new], b[new], self.places[self.row[at[order[new]]]]
        return out, which, first


def _cuts(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of the sorted hashes begins; one more entry for the end."""
    edge = [-(-(b << 64) // buckets) for b in range(1, buckets)]
    return np.concatenate(([0], np.searchsorted(h, np.array(edge, dtype=np.uint64)), [len(h)])).astype(np.int64)


def _messages(block: int, buckets: int, h: np.ndarray, more: np.ndarray) -> pa.Table:
    """One row a bucket that has hashes; ``more``: a bit, or a whole record, for each hash."""
    cut = _cuts(h, buckets)
    rows = np.flatnonzero(cut[1:] > cut[:-1]).tolist()
    pack = (lambda x: np.packbits(x).tobytes()) if more.dtype == bool else (lambda x: x.tobytes())
    own = (lambda x: x.tobytes()) if more.dtype == bool else (lambda x: b"")
    return pa.table(
        {
            "bucket": pa.array(rows, pa.int64()), "block": pa.array([block] * len(rows), pa.int32()),
            "h": pa.array([own(h[cut[b] : cut[b + 1]]) for b in rows], pa.binary()),
            "more": pa.array([pack(more[cut[b] : cut[b + 1]]) for b in rows], pa.binary())
        }
    )


def _bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


_MESSAGE = "bucket long, block int, h binary, more binary"
_ANSWER = "block int, kind int, bucket long, bits binary"
_ANSWER_PA = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int64()), ("bits", pa.binary())])


def _answers(table: pa.Table, kind: int, found: list[np.ndarray]) -> pa.Table:
    return pa.table(
        [
            table["block"].cast(pa.int32()), pa.array([kind] * len(table), pa.int32()), table["bucket"],
            pa.array([np.packbits(f).tobytes() for f in found], pa.binary())
        ],
        schema=_ANSWER_PA
    )


def _shared(table):
    """Step 2: which symbols of each block occur in another block, or twice in their own."""
    hs = [np.frombuffer(b, np.uint64) for b in table["h"].to_pylist()]
    again = np.concatenate([_bits(b, len(h)) for b, h in zip(table["more"].to_pylist(), hs, strict=True)])
    h = np.concatenate(hs)
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(len(s), dtype=bool)
    hit[1:] |= same
    hit[:-1] |= same
    again[order] |= hit
    return _answers(table, 0, np.split(again, np.cumsum([len(x) for x in hs])[:-1]))


def _earlier(table: pa.Table, buckets: int) -> pa.Table:
    """Step 4: which windows of each block an earlier document of another block has.  A block's own row (which windows were sent) passes through."""
    if table["bucket"][0].as_py() >= buckets:
        return pa.table(
            [table["block"].cast(pa.int32()), pa.array([1] * len(table), pa.int32()), table["bucket"], table["h"]],
            schema=_ANSWER_PA
        )
    each = [np.frombuffer(b, _WINDOW) for b in table["more"].to_pylist()]
    w = np.concatenate(each)
    order = np.lexsort((w["place"]["row"], w["place"]["id"], w["h2"], w["h1"]))
    a, b = w["h1"][order], w["h2"][order]
    late = np.zeros(len(a), dtype=bool)
    late[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return _answers(table, 2, np.split(late, np.cumsum([len(x) for x in each])[:-1]))


def _collected(answers: pa.Table, kind: int, sizes: np.ndarray) -> np.ndarray:
    """The answers of one kind, put together in the order in which the hashes were sent."""
    out = np.zeros(int(sizes.sum()), dtype=bool)
    at = np.concatenate(([0], np.cumsum(sizes)))
    for k, b, bits in zip(
        answers["kind"].to_pylist(), answers["bucket"].to_pylist(), answers["bits"].to_pylist(), strict=True
    ):
        if k == kind:
            out[at[b] : at[b + 1]] = _bits(bits, int(sizes[b]))
    return out


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = 20, rounds: int = ROUNDS,
    block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Remove each word that lies in a run of ``min_words`` words which also starts earlier.

    "Earlier" is a smaller id, or an earlier start in the same document, as the
    input stands.  Returns a row for each input row: the id column, ``n_words``,
    ``n_removed`` (long), ``kept_text`` (the kept words joined by one space) and
    ``removed`` (array of struct start, end: maximal runs of removed words).

    * null text: no words, kept text empty; null ids come before all others;
    * rows with one id count as documents one after another, in the order of a hash
      of their texts; of rows that are equal in id and text one stays;
    * documents of fewer than ``min_words`` words lose nothing;
    * an empty table gives an empty result; other columns are ignored;
    * documents of any length are hashed whole.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumn("row", F.xxhash64("text"))
    total = src.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks, buckets = max(1, math.ceil(total / block_bytes)), max(1, math.ceil(total / 24 / BUCKET_HASHES))
    if total:
        buckets = max(buckets, min(blocks, parts))

    def name_symbols(key, table):
        block = _Block(table, min_words, rounds)
        return _messages(key[0].as_py(), buckets, block.names, block.again)

    def send_windows(key, table, answers):
        n, block = key[0].as_py(), _Block(table, min_words, rounds)
        shared = _collected(answers, 0, np.diff(_cuts(block.names, buckets)))
        at = block.candidates(shared)
        found, _, _ = block.windows(at)
        sent = np.zeros(len(block.words), dtype=bool)
        sent[at] = True
        own = pa.table(
            {
                "bucket": pa.array([buckets + n], pa.int64()), "block": pa.array([n], pa.int32()),
                "h": pa.array([np.packbits(sent).tobytes()], pa.binary()), "more": pa.array([b""], pa.binary())
            }
        )
        return pa.concat_tables([_messages(n, buckets, found["h1"], found), own])

    def keep_words(key, table, answers):
        block = _Block(table, min_words, 0)
        blob = next(b for k, b in zip(answers["kind"].to_pylist(), answers["bits"].to_pylist(), strict=True) if k == 1)
        at = np.flatnonzero(_bits(blob, len(block.words)))
        found, which, first = block.windows(at)
        late = _collected(answers, 2, np.diff(_cuts(found["h1"], buckets)))
        gone = T.covered(at[late[which] | ~first], min_words, len(block.words))
        removed = T.per_row(gone, block.woff)
        kept, runs = [], []
        data, woff = block.buf.tobytes(), block.woff
        for i in range(len(block.table)):
            words = data[block.off[i] : block.off[i + 1]].split()
            if removed[i]:
                g = gone[woff[i] : woff[i + 1]]
                words = [words[j] for j in np.flatnonzero(~g)]
                edge = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
                runs.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            else:
                runs.append([])
            kept.append(b" ".join(words))
        return pa.table(
            {
                "id": block.table["id"], "n_words": pa.array(np.diff(woff)), "n_removed": pa.array(removed),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                "removed": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            }
        )

    bound_batches(docs.sparkSession)
    dealt = src.select(F.pmod(F.xxhash64("id", "row"), F.lit(blocks)).cast("int").alias("block"), "id", "text", "row")
    symbols = dealt.groupBy("block").applyInArrow(name_symbols, _MESSAGE)
    shared = symbols.groupBy("bucket").applyInArrow(_shared, _ANSWER)
    windows = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(send_windows, _MESSAGE)
    late = windows.groupBy("bucket").applyInArrow(lambda t: _earlier(t, buckets), _ANSWER)
    out = dealt.groupBy("block").cogroup(late.groupBy("block")).applyInArrow(
        keep_words,
        "id long, n_words long, n_removed long, kept_text string, removed array<struct<start: long, end: long>>"
    )
    return out.withColumnRenamed("id", id_col)


def oracle(table: str = "documents", width: int = 20) -> str:
    """The same words in SQL, from all windows."""
    return rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM {table}),
k AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + {width - 1}], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {width - 2})) AS i FROM d)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM late, range({width}) t(j)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT x.doc_id, count(gone.i) AS n, coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (gone.i IS NULL), '') AS t FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(g.t, '')) AS kept_sha256 FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""
