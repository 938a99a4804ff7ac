"""Cost-balanced packing of documents into fixed-length training sequences.

Attention inside a sequence is taken to be block-diagonal, so a piece of n tokens
costs ``linear * n + quadratic * n * n``.  Pieces go in descending length to the
cheapest sequence that still has room; a piece that fits nowhere whole is cut at
the roomiest one.  Each task tokenises its own documents and packs them in groups
of a few million tokens, so token ids never leave the task that made them: there
is no shuffle, a task holds one group, and a task run again gives the same rows.

Tokenising looks up *units*: maximal runs of non-space bytes with the one space
before them, less a closing run of ASCII punctuation, which is a unit of its own
after an ASCII letter or digit or a Latin-1 letter, as is the white space
between.  The byte-level pre-tokeniser never joins across units, so a unit's ids
do not depend on its neighbours; new units are encoded once and kept in a table
of fixed size.  Texts with white space
beyond ASCII, where that argument fails, are encoded whole.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .storage import bound_batches

SEQUENCE = 2048
END_ID = 1
#: Tokens that are packed together; what a task holds of ids.
GROUP_TOKENS = 1 << 21
#: ASCII punctuation but the apostrophe, which can begin a contraction, and what can end a special token.
_POINT = np.zeros(256, bool)
_POINT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'|>"]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[c for c in range(0x30, 0x7F) if chr(c).isalnum()]] = True
#: Text bytes tokenised at a time.
SLICE_BYTES = 1 << 20
_SLOTS = 1 << 21
_POOL = 1 << 23
#: New units that are encoded at a time.
_CHUNK = 4096


class UnitTokenizer:
    """Ids of many texts at once, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.others = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.uint64)
        self.at, self.size = np.zeros(_SLOTS, np.int32), np.zeros(_SLOTS, np.uint16)
        self.pool, self.used = np.zeros(1 << 20, np.uint16), 0

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of new strings stand, and how many there are."""
        sizes, ids = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for k in range(0, len(texts), _CHUNK):
            lists = [e.ids for e in self.tokenizer.encode_batch(texts[k : k + _CHUNK], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, lists), np.int32, len(lists)))
            ids.append(np.fromiter(chain.from_iterable(lists), np.int64, int(sizes[-1].sum())))
        size, flat = np.concatenate(sizes), np.concatenate(ids)
        if len(flat) and flat.max() > np.iinfo(self.pool.dtype).max:
            self.pool = self.pool.astype(np.uint32)
        end = self.used + len(flat)
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool) // 2, len(flat)), self.pool.dtype)])
        self.pool[self.used : end] = flat
        at = (self.used + np.cumsum(size) - size).astype(np.int32)
        self.used = end
        return at, size

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after another, and the n + 1 offsets of the rows."""
        if self.used > _POOL:
            self._clear()
        starts, ends, woff = T.spans(buf, off)
        whole = np.zeros(len(off) - 1, bool)
        for at in _wide_space(buf):
            whole[np.searchsorted(off, at, side="right") - 1] = True
        us, ue, first = _units(buf, off, starts, ends, woff)
        # Units of up to eight bytes cannot collide at one length; longer ones are told apart by a second hash.
        h, other = T.hash_spans(buf, us, ue), (ue - us).astype(np.uint64)
        long = np.flatnonzero(ue - us > 8)
        other[long] = T.hash_spans(buf, us[long], ue[long], seed=1)
        slot = (h >> np.uint64(20)).astype(np.int64) & (_SLOTS - 1)
        at, size = self.at[slot], self.size[slot].astype(np.int32)
        miss = np.flatnonzero((self.keys[slot] != h) | (self.others[slot] != other))
        if len(miss):
            order = np.lexsort((other[miss], h[miss]))
            a, b = h[miss][order], other[miss][order]
            first_of = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            back = np.empty(len(miss), np.int64)
            back[order] = np.cumsum(first_of) - 1
            data, pick = buf.tobytes(), miss[order[first_of]]
            a, n = self._encode([data[i:j].decode() for i, j in zip(us[pick].tolist(), ue[pick].tolist(), strict=True)])
            at[miss], size[miss] = a[back], n[back]
            s, keep = slot[pick], n < 1 << 16
            self.keys[s[keep]], self.others[s[keep]] = h[pick[keep]], other[pick[keep]]
            self.at[s[keep]], self.size[s[keep]] = a[keep], n[keep]
        for d in np.flatnonzero(whole):
            lo, hi = first[d], first[d + 1]
            a, n = self._encode([buf[off[d] : off[d + 1]].tobytes().decode()])
            size[lo:hi] = 0
            at[lo], size[lo] = a[0], n[0]
        end = np.cumsum(size, dtype=np.int64)
        total = int(end[-1]) if len(end) else 0
        ids = self.pool[np.repeat((at - (end - size)).astype(np.int32), size) + np.arange(total, dtype=np.int32)]
        return ids, np.concatenate(([0], end))[first]


@lru_cache(maxsize=2)
def unit_tokenizer(path: str) -> UnitTokenizer:
    return UnitTokenizer(path)


def _wide_space(buf: np.ndarray) -> np.ndarray:
    """Where white space beyond ASCII begins: U+0085, U+00A0, U+1680, U+2000-200A, U+2028-2029, U+202F, U+205F, U+3000."""
    at = np.flatnonzero((buf == 0xC2) | ((buf >= 0xE1) & (buf <= 0xE3)))
    pad = np.concatenate([buf, np.zeros(2, np.uint8)])
    a, b, c = buf[at], pad[at + 1], pad[at + 2]
    hit = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    hit |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    hit |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    hit |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[hit]


def _units(buf, off, starts, ends, woff):
    """Start and end of each unit in text order, and the n + 1 unit offsets of the rows."""
    row = T.row_of(woff)
    spaced = (starts > off[row]) & (buf[np.maximum(starts - 1, 0)] == 0x20) if len(starts) else np.zeros(0, bool)
    us = starts - spaced
    before = np.empty(len(starts), np.int64)
    if len(starts):
        before[0] = 0
        before[1:] = ends[:-1]
        np.maximum(before, off[row], out=before)
    gap = us - before
    split = ~spaced & (gap >= 2)
    a, b = np.flatnonzero(gap >= 1), np.flatnonzero(split)
    n = np.diff(off)
    has = np.flatnonzero(n > 0)
    last = off[:-1].copy()
    some = np.flatnonzero(np.diff(woff) > 0)
    last[some] = ends[woff[some + 1] - 1]
    t = has[last[has] < off[has + 1]]
    place = np.concatenate([a, b, woff[t + 1]])
    ns = np.concatenate([before[a], us[b] - 1, last[t]])
    ne = np.concatenate([us[a] - split[a], us[b], off[t + 1]])
    order = np.argsort(ns, kind="stable")
    us, ue = np.insert(us, place[order], ns[order]), np.insert(ends, place[order], ne[order])
    # Closing punctuation.
    c = np.flatnonzero(_POINT[buf[ue - 1]]) if len(ue) else np.zeros(0, np.int64)
    if len(c):
        last = np.maximum.accumulate(
            np.where(_POINT[buf], 0, np.arange(len(buf), dtype=np.int32))
        )[ue[c] - 1].astype(np.int64)
        lead = buf[np.maximum(last - 1, 0)]
        letter = _ALNUM[buf[last]] | ((lead == 0xC3) & (buf[last] >= 0x80) & (buf[last] != 0x97) & (buf[last] != 0xB7))
        c, cut = c[(last >= us[c]) & letter], last[(last >= us[c]) & letter] + 1
        tail = ue[c]
        ue = ue.copy()
        ue[c] = cut
        us, ue = np.insert(us, c + 1, cut), np.insert(ue, c + 1, tail)
    return us, ue, np.searchsorted(us, off)


def assign(
    sizes: np.ndarray, capacity: int = SEQUENCE, linear: float = 1.0, quadratic: float = 1.0 / SEQUENCE
) -> list[tuple[int, int, int, int, int]]:
    """Pack documents of the given sizes: (document, start, length, sequence, offset) for each piece."""
    out, items, n_seq = [], [], 0
    for doc, size in enumerate(sizes.tolist()):
        full = size // capacity
        for k in range(full):
            out.append((doc, k * capacity, capacity, n_seq, 0))
            n_seq += 1
        if size % capacity:
            items.append((size % capacity, doc, full * capacity))
    shared = -(-sum(x[0] for x in items) // capacity)
    cost, room = np.zeros(shared), np.full(shared, capacity, np.int64)
    items.sort(key=lambda x: (-x[0], x[1]))
    for size, doc, start in items:
        while size:
            fits = room >= size
            if fits.any():
                k, part = int(np.where(fits, cost, np.inf).argmin()), size
            else:
                k = int(room.argmax())
                part = int(room[k])
            out.append((doc, start, part, n_seq + k, capacity - int(room[k])))
            room[k] -= part
            cost[k] += linear * part + quadratic * part * part
            start, size = start + part, size - part
    return out


_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = SEQUENCE,
    end_id: int = END_ID, linear: float = 1.0, quadratic: float = 1.0 / SEQUENCE, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """Tokenise and pack all rows.

    Returns a row for each piece: ``doc_id``, ``start`` and ``length`` in the
    document's ids (its end id included), ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence and the piece's
    ``cost``.  Every id lies in one piece, offsets of a sequence have no gaps, and
    only the last sequence of a group is not full.

    * null and empty texts are one end id; null ids stay null; repeated rows are
      packed each on its own; an empty table gives no pieces;
    * texts of any length are tokenised whole; other columns are ignored.
    """

    def pack(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = unit_tokenizer(tokenizer_path)
        base, ids, held, tokens = TaskContext.get().partitionId() << 32, [], [], 0

        def flush():
            nonlocal base, ids, held, tokens
            sizes = np.array([len(x) for x in held], np.int64)
            pieces = assign(sizes, capacity, linear, quadratic)
            for k in range(0, len(pieces), 500):
                some = pieces[k : k + 500]
                col = [np.array(x, np.int64) for x in zip(*some, strict=True)]
                blobs = [held[p[0]][p[1] : p[1] + p[2]].astype("<u4").tobytes() for p in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[p[0]] for p in some], pa.int64()), pa.array(col[1]), pa.array(col[2]),
                        pa.array(blobs, pa.binary()), pa.array(sizes[col[0]]), pa.array(col[3] + base),
                        pa.array(col[4]), pa.array(linear * col[2] + quadratic * col[2].astype(float) ** 2)
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"]
                )
            base += max((p[3] for p in pieces), default=-1) + 1
            ids, held, tokens = [], [], 0

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                flat, at = tok.encode(*T.column_bytes(part.column(1)))
                ids += part.column(0).to_pylist()
                held += [
                    np.append(flat[a:b], flat.dtype.type(end_id)) for a,
                    b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
                ]
                tokens += len(flat) + len(part)
                if tokens >= group_tokens:
                    yield from flush()
        if held:
            yield from flush()
        T.release()

    bound_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(pack, _SCHEMA)


def slices(batch: pa.RecordBatch, column: int, limit: int):
    """Parts of a batch of about ``limit`` text bytes, one row at least."""
    _, off = T.column_bytes(batch.column(column))
    i, n = 0, len(batch)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
