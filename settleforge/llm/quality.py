"""Quality rules as a short-circuit cascade.

Each rule rejects a document from a few measures of its text.  On a bounded
sample the cost of each rule (seconds, its own measures included) and its
rejection rate are estimated; rules then run in descending order of rejection
per cost, each only on the documents that all rules before it let pass.  The
verdict is the same in every order, so the estimates change speed and nothing else.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .packing import slices
from .storage import bound_batches

#: Documents in the sample that orders the rules, and the longest text in it; they bound what the driver gets.
SAMPLE_ROWS, SAMPLE_TEXT = 400, 200_000
SLICE_BYTES = 2 << 20
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_SHOUT = np.zeros(256, bool)
_SHOUT[list(b"!?")] = True


class Texts:
    """The texts of a batch; each measure is made once, when it is first asked for."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self._made = buf, off, {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._made:
            self._made[name] = getattr(self, f"_{name}")()
        return self._made[name]

    def subset(self, rows: np.ndarray) -> Texts:
        """Some of the texts, with what was measured of them."""
        if len(rows) == len(self.off) - 1:
            return self
        keep = np.zeros(len(self.off) - 1, bool)
        keep[rows] = True
        out = Texts(
            self.buf[np.repeat(keep, np.diff(self.off))], np.concatenate(([0], np.cumsum(np.diff(self.off)[rows])))
        )
        out._made = {k: v[rows] for k, v in self._made.items() if k not in ("words", "lines", "hashes")}
        return out

    def _count(self, table: np.ndarray) -> np.ndarray:
        return T.per_row(table[self.buf], self.off)

    def _words(self):
        return T.spans(self.buf, self.off)

    def _n_words(self) -> np.ndarray:
        return np.diff(self["words"][2])

    def _word_chars(self) -> np.ndarray:
        table = T.NOT_SPACE.copy()
        table[0x80:0xC0] = False
        return self._count(table)

    def _n_symbols(self) -> np.ndarray:
        return self._count(_SYMBOL)

    def _n_letters(self) -> np.ndarray:
        return self._count(_LETTER)

    def _n_upper(self) -> np.ndarray:
        return self._count(_UPPER)

    def _n_shouts(self) -> np.ndarray:
        return self._count(_SHOUT)

    def _lines(self):
        """Hash and row of each line that has a word."""
        s, e, loff = T.spans(self.buf, self.off, _LINE)
        has = np.searchsorted(self["words"][0], e) > np.searchsorted(self["words"][0], s)
        row = T.row_of(loff)[has]
        return T.hash_spans(self.buf, s[has], e[has]), row

    def _n_lines(self) -> np.ndarray:
        return np.bincount(self["lines"][1], minlength=len(self.off) - 1)

    def _n_dup_lines(self) -> np.ndarray:
        h, row = self["lines"]
        _, first = np.unique(T.mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        return self["n_lines"] - np.bincount(row[first], minlength=len(self.off) - 1)

    def _hashes(self) -> np.ndarray:
        s, e, _ = self["words"]
        return T.hash_spans(self.buf, s, e)

    def _n_stutters(self) -> np.ndarray:
        """Words equal to the word before."""
        h, row = self["hashes"], T.row_of(self["words"][2])
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        return T.per_row(again, self["words"][2])

    def _n_repeat_words(self) -> np.ndarray:
        s, e, woff = self["words"]
        row = T.row_of(woff)
        n = len(s)
        if n < WINDOW:
            return np.zeros(len(self.off) - 1, np.int64)
        h = T.fold(self["hashes"], WINDOW, 0x2545F4914F6CDD1D)
        at = np.flatnonzero(row[: n - WINDOW + 1] == row[WINDOW - 1 :])
        key = T.mix(h[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return np.zeros(len(self.off) - 1, np.int64)
        hit = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
        return T.per_row(T.covered(at[hit], WINDOW, n), woff)


@dataclass(frozen=True)
class Rule:
    """``fails`` gives, from the measures of some texts, which of them the rule rejects."""

    name: str
    fails: Callable[[Texts], np.ndarray]


#: What every document must pass.
BASE_RULES = (
    Rule("too_few_words", lambda t: t["n_words"] < 20),
    Rule("repeated_words", lambda t: 100 * t["n_repeat_words"] > 30 * t["n_words"]),
)
#: The rest of the default cascade.
RULES = BASE_RULES + (
    Rule("symbols", lambda t: 10 * t["n_symbols"] > 2 * t["n_words"]),
    Rule("capitals", lambda t: (t["n_letters"] >= 40) & (100 * t["n_upper"] > 50 * t["n_letters"])),
    Rule("shouting", lambda t: 10 * t["n_shouts"] > 4 * t["n_words"]),
    Rule("stutter", lambda t: 100 * t["n_stutters"] > 40 * t["n_words"]),
    Rule("repeated_lines", lambda t: (t["n_lines"] >= 4) & (100 * t["n_dup_lines"] > 50 * t["n_lines"])),
    Rule(
        "word_length",
        lambda t: (t["n_words"] >= 20) & ((t["word_chars"] < 2 * t["n_words"]) | (t["word_chars"] > 25 * t["n_words"]))
    ),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ordered_rules(
    docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str, rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by descending rejection per cost, as a sample of at most ``rows`` documents shows them."""
    text = F.col(text_col).cast("string")
    some = docs.where(F.octet_length(text) <= SAMPLE_TEXT).where(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(8)) == 0
    ).select(text.alias("text")).limit(rows).collect()
    if not some:
        return list(rules)
    buf, off = T.column_bytes(pa.array([r[0] for r in some], pa.string()))
    rate = {}
    for rule in rules:
        began = time.perf_counter()
        lost = rule.fails(Texts(buf, off)).mean()
        rate[rule.name] = lost / max(time.perf_counter() - began, 1e-9)
    return sorted(rules, key=lambda r: (-rate[r.name], r.name))


def cascade(texts: Texts, rules: list[Rule]) -> np.ndarray:
    """The rows that every rule lets pass.

    Rejected texts are cut out, so later rules do not see them, once they hold
    enough bytes to be worth it; measures of the others are carried over.
    """
    left, alive = np.arange(len(texts.off) - 1), np.ones(len(texts.off) - 1, bool)
    for rule in rules:
        alive &= ~rule.fails(texts)
        size = np.diff(texts.off)
        if 4 * size[alive].sum() <= 3 * size.sum():
            at = np.flatnonzero(alive)
            left, texts, alive = left[at], texts.subset(at), np.ones(len(at), bool)
    return left[alive]


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rules: tuple[Rule, ...] = RULES,
    base: tuple[Rule, ...] = BASE_RULES, measures: bool = True, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Judge each document.

    Returns a row for each input row: the id, the ``carry`` columns as they are,
    the measures ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    (long; only with ``measures``), ``base_failed`` (only with ``measures``) and
    ``kept``: no rule of ``base`` or ``rules`` rejects the text.  Without
    ``measures`` the cascade stops at a document's first rejection.

    * null text counts as empty, and so has too few words; null ids stay null;
    * repeated rows are judged each on its own; an empty table gives no rows;
    * measures see whole texts; a carried column may be called like one of the
      result's, which then holds two of that name (take them by position).
    """
    bound_batches(docs.sparkSession)
    every = tuple({r.name: r for r in base + rules}.values())
    order = ordered_rules(docs, every, id_col, text_col)

    # A text that is carried is not sent a second time.
    own = text_col in carry and docs.schema[text_col].dataType.simpleString() == "string"
    at, first = (1 + carry.index(text_col), 1) if own else (1, 2)

    def judge(batches):
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                t = Texts(*T.column_bytes(part.column(at)))
                own = [pa.array(t[m].astype(np.int64)) for m in MEASURES] if measures else []
                kept = np.zeros(len(part), bool)
                kept[cascade(t, order)] = True
                cols = [part.column(0), *[part.column(i) for i in range(first, part.num_columns)]]
                if measures:
                    failed = np.zeros(len(part), bool)
                    for r in base:
                        failed |= r.fails(t)
                    cols += [*own, pa.array(failed)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(kept)], names=names)
        T.release()

    text = [] if own else [F.col(text_col).cast("string").alias("_text")]
    src = docs.select(F.col(id_col).alias("_id"), *text, *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    kind = lambda c: docs.schema[c].dataType.simpleString()
    kinds = [f"_id {kind(id_col)}", *[f"_c{i} {kind(c)}" for i, c in enumerate(carry)]]
    if measures:
        kinds += [f"{m} long" for m in MEASURES] + ["base_failed boolean"]
    names = ["_id", *[f"_c{i}" for i in range(len(carry))], *(MEASURES + ("base_failed",) if measures else ()), "kept"]
    out = src.mapInArrow(judge, ", ".join([*kinds, "kept boolean"]))
    return out.toDF(id_col, *carry, *names[1 + len(carry) :])


def oracle(table: str = "documents") -> str:
    """The same measures and rules in SQL; every rule on every text."""
    word = r"[^\x20\x09-\x0D]+"
    count = lambda chars: f"len(regexp_extract_all(t, '[{chars}]'))"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {table}),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{word}') AS w FROM d),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{word}') GROUP BY 1),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w))),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM g, range({WINDOW}) t(j) WHERE n > 1 GROUP BY 1),
x AS (SELECT doc_id, count(*) AS n_stutters FROM (SELECT doc_id, w, unnest(range(2, len(w) + 1)) AS i FROM w) WHERE w[i] = w[i - 1] GROUP BY 1),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, {count('#*$%&|<>')}::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_stutters, 0) AS n_stutters, {count('A-Za-z')} AS n_letters, {count('A-Z')} AS n_upper, {count('!?')} AS n_shouts
  FROM w LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN x USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 2 * n_words OR (n_letters >= 40 AND 100 * n_upper > 50 * n_letters) OR 10 * n_shouts > 4 * n_words OR 100 * n_stutters > 40 * n_words
    OR (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines) OR (n_words >= 20 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words))) AS kept FROM b"""
