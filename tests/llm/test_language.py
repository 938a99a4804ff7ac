"""Spelling variants, n-gram scores and co-bucketed tables against brute-force versions."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from test_operators import SCHEMA, awkward, rows_of

LETTERS = "[A-Za-zÀ-ÿ]+"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- spelling variants ---------------------------------------------------------------------------


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute_counts(rows, every):
    n = collections.Counter()
    for i, t in rows:
        for r in re.findall(LETTERS, t or ""):
            r = lower(r)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if every and h % every == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            n[r] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def spelled():
    """Words with planted edits, common beginnings and ends, letters beyond ASCII, chains of forms, repeated rows."""
    r = random.Random(3)
    base = ["".join(r.choice("abcdeé") for _ in range(r.randint(6, 12))) for _ in range(60)]
    base += ["common" + a + b for a in "abcdefgh" for b in "abcdefgh"] + [a + b + "ending" for a in "abcdef" for b in "abcé"]
    texts = []
    for k in range(300):
        words = []
        for w in r.choices(base, [1 / (1 + i) for i in range(len(base))], k=30):
            if r.random() < 0.2:
                p = r.randrange(len(w))
                w = r.choice([w[:p] + w[p + 1 :], w[:p] + "x" + w[p:], w[:p] + "É" + w[p + 1 :], w.upper()])
            words.append(w)
        texts.append((k, "-".join(words)))
    texts.append((1000, " ".join(["chained"] * 2000 + ["chainedy"] * 150 + ["chainedyy"] * 12)))
    return rows_of(texts + [(7, texts[7][1]), (None, "nothing nothing"), (2000, None), (2001, ""), (2002, "letters" * 900)] )


@pytest.mark.parametrize("bucket_words", [4, 64])
def test_variants(spark, bucket_words):
    from settleforge.llm.spelling import group_variants

    rows = spelled()
    got = group_variants(spark.createDataFrame(rows, SCHEMA).repartition(3), drop_every=31, bucket_words=bucket_words)
    want = brute_variants(brute_counts([(r[0], r[1]) for r in rows], 31))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert any(f is not None and root != f for _, f, root, *_ in want)


def test_variants_empty(empty):
    from settleforge.llm.spelling import group_variants

    assert group_variants(empty).collect() == []


# --- n-gram scores -------------------------------------------------------------------------------


class Brute:
    """The same model over dictionaries of words."""

    def __init__(self, texts, order):
        from settleforge.llm.ngram_lm import discounts

        self.order, counts = order, collections.Counter()
        self.raw = collections.Counter(t for x in texts for t in self.tokens(x))
        for x in texts:
            seq = [None] * (order - 2) + ["<s>"] * (order > 1) + self.tokens(x)
            for i in range(order - 1, len(seq)):
                counts[tuple(seq[i - order + 1 : i + 1])] += 1
        self.n = {order: {g: c for g, c in counts.items() if g[0] is not None}}
        passed = {g: c for g, c in counts.items() if g[0] is None}
        for k in range(order - 1, 0, -1):
            low = collections.Counter(g[1:] for g in self.n[k + 1])
            for g, c in passed.items():
                low[g[1:]] += c
            passed = {g: c for g, c in low.items() if g[0] is None}
            self.n[k] = {g: c for g, c in low.items() if g[0] is not None}
        self.d, self.context = {}, {}
        for k, grams in self.n.items():
            self.d[k] = discounts(*[sum(c == i for c in grams.values()) for i in (1, 2, 3, 4)])
            self.context[k] = collections.defaultdict(list)
            for g, c in grams.items():
                self.context[k][g[:-1]].append(c)

    @staticmethod
    def tokens(x):
        return [w.decode() for w in lower(x or "").encode().split()] + ["</s>end"]

    def p(self, g):
        if not g:
            return 1 / (len(self.raw) + 1)
        k, found = len(g), self.context[len(g)].get(g[:-1])
        if not found:
            return self.p(g[1:])
        c = self.n[k].get(g, 0)
        left = sum(self.d[k][min(x, 3)] for x in found)
        return (c - self.d[k][min(c, 3)] + left * self.p(g[1:])) / sum(found)

    def score(self, x):
        seq = [None] * (self.order - 2) + ["<s>"] * (self.order > 1) + self.tokens(x)
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(seq)))


def prose():
    r = random.Random(9)
    words = [f"W{k}" for k in range(40)]
    text = lambda n: " ".join(words[min(39, int(r.expovariate(0.15)))] for _ in range(n))
    often = [(400 + i, "w1 w1 " * 200) for i in range(3)]  # counts beyond one byte
    return awkward() + rows_of([(100 + i, text(r.randint(0, 60))) for i in range(150)] + often)


def out_of(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


@pytest.mark.parametrize("order,shard_tokens,wide", [(1, 1 << 21, None), (2, 200, None), (2, 1 << 21, True), (3, 400, None), (4, 1 << 21, None), (4, 600, True)])
def test_ngrams(spark, order, shard_tokens, wide):
    from settleforge.llm.ngram_lm import score_texts

    rows = prose()
    got = score_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), order=order, shard_tokens=shard_tokens, wide=wide).collect()
    model = Brute([t for i, t, *_ in rows if not out_of(i)], order)
    total, kinds = sum(model.raw.values()), len(model.raw)
    want = []
    for i, t, *_ in rows:
        tokens = model.tokens(t)
        base = sum(math.log10((model.raw[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in tokens)
        want.append((i, out_of(i), len(tokens), sum(model.raw[x] > 0 for x in tokens), total, base, model.score(t)))
    by = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    for a, b in zip(sorted(map(tuple, got), key=by), sorted(want, key=by), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_add_up():
    rows = prose()
    model = Brute([t for i, t, *_ in rows if not out_of(i)], 3)
    for context in [("<s>",), ("<s>", "w1"), ("w1", "w2"), ("w3",), ("never", "seen")]:
        assert sum(model.p((*context, w)) for w in [*model.raw, "unknown"]) == pytest.approx(1)


def test_ngrams_empty(empty, spark):
    from settleforge.llm.ngram_lm import score_texts

    assert score_texts(empty).collect() == []
    held = next(i for i in range(100) if out_of(i))
    (r,) = score_texts(spark.createDataFrame(rows_of([(held, "a b")]), SCHEMA)).collect()
    assert tuple(r) == (held, True, 3, 0, 0, 0.0, 0.0)


# --- co-bucketed tables --------------------------------------------------------------------------


def ordered(r):
    return tuple((x is not None, x.encode() if isinstance(x, str) else 0 if x is None else x) for x in r)


def brute_files(parents, children, buckets, start_parent, start_child):
    """{(table, bucket): (rows in order, Counter of starting files)} and the joined rows by bucket."""
    n = collections.Counter(r[0] for r in parents if r[0] is not None)
    bucket = lambda k: zlib.crc32(f"s{k}".encode()) % buckets
    out, joined = {}, collections.Counter()
    for name, rows, start in (("p", parents, start_parent), ("c", children, start_child)):
        for r in rows:
            b = buckets + 1 if r[0] is None else buckets if name == "c" and r[0] not in n else bucket(r[0])
            files = out.setdefault((name, b), ([], collections.Counter()))
            files[0].append(r)
            files[1][start(r, b)] += 1
            if name == "c":
                joined[b] += n.get(r[0], 0)
    return {k: (sorted(rows, key=ordered), s) for k, (rows, s) in out.items()}, joined


def test_pair(spark):
    from settleforge.llm.cobucket import bucket_of, rewrite_pair

    r = random.Random(1)
    texts = [None, "", "a", "ab", "é", "日本", "a\x00b", "z" * 70000]
    doubles = [None, 0.0, -0.0, 1.5, -1.5, math.inf, -math.inf]
    parents = [(r.choice([None, *range(40)]), r.choice(doubles), r.choice(texts), r.choice([None, True, False]), k) for k in range(150)]
    parents += [(77, None, None, None, None)] * 3
    # A third of the children has one key; some have none or one without parent.
    children = [(r.choice([5, None, -3, 10**12, *range(40)]) if k % 3 else 5, r.choice([None, *range(9)]), r.choice(texts), k) for k in range(400)]
    p = spark.createDataFrame(parents, "id long, x double, _s string, number boolean, n int").repartition(3)
    c = spark.createDataFrame(children, "id long, c0 long, path string, k int").repartition(4)
    b = F.coalesce(bucket_of(F.col("id"), 12), F.lit(13))
    got = rewrite_pair(p, c, "id", F.when(b % 4 == 1, b - 1).otherwise(b), F.coalesce(F.col("c0") % 7, F.lit(0)), names=("p", "c"), buckets=12, partitions=5).collect()
    want, joined = brute_files(parents, children, 12, lambda r, b: b - 1 if b % 4 == 1 else b, lambda r, b: (r[1] or 0) % 7)
    used = collections.Counter((name, s) for (name, _), (_, starts) in want.items() for s in starts)
    assert {(x["table_name"], x["bucket"]) for x in got} == set(want) and len(got) == len(want)
    assert {x["rewritten"] for x in got} == {True, False}
    sha = lambda x: hashlib.sha256(",".join(x).encode()).hexdigest()
    for x in got:
        rows, starts = want[x["table_name"], x["bucket"]]
        table = pq.read_table(x["path"])
        have = list(zip(*[col.to_pylist() for col in table.columns]))
        assert [ordered(h) for h in have] == [ordered(h) for h in rows]
        assert sorted(map(repr, have)) == sorted(map(repr, rows))  # signs of zeros too
        assert x["columns"] == ",".join(table.column_names) == ",".join((p if x["table_name"] == "p" else c).columns)
        assert x["ids_sha256"] == sha("" if h[0] is None else str(h[0]) for h in rows)
        assert x["lineage_sha256"] == sha(f"{s}:{n}" for s, n in sorted(starts.items()))
        assert (x["n_rows"], x["n_joined"]) == (len(rows), joined[x["bucket"]])
        assert x["rewritten"] != (len(starts) == 1 and used[x["table_name"], next(iter(starts))] == 1)
    folder = os.path.dirname(os.path.dirname(got[0]["path"]))
    assert sorted(os.path.join(d, f) for d, _, files in os.walk(folder) for f in files) == sorted(x["path"] for x in got)


def test_pair_empty(spark):
    from settleforge.llm.cobucket import rewrite_pair

    none = spark.createDataFrame([], "id long, x date")
    assert rewrite_pair(none, none, "id", F.lit(0), F.lit(0), buckets=3).collect() == []
    some = spark.createDataFrame([(1, None), (None, None)], "id long, x date")
    got = rewrite_pair(none, some, "id", F.lit(0), F.lit(0), buckets=3).collect()
    assert sorted((x["table_name"], x["bucket"], x["n_rows"], x["n_joined"]) for x in got) == [("children", 3, 1, 0), ("children", 4, 1, 0)]
    with pytest.raises(TypeError):
        rewrite_pair(some.withColumn("x", F.array("id")), some, "id", F.lit(0), F.lit(0))


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "string", "boolean"])
def test_codec(kind):
    import numpy as np
    import pyarrow as pa

    from settleforge.llm.cobucket import _KINDS, RowCodec

    typ = _KINDS[kind][1]
    if kind == "string":
        values = ["", "a", "\x00", "a\x00", "é", "\U0010ffff", "ab"]
    elif kind == "boolean":
        values = [False, True]
    elif kind in ("float", "double"):
        values = [-math.inf, -2.5, 0.0, 1e-30, 3.0, math.inf]
    else:
        values = [-100, -1, 0, 1, 100]
    plain = pa.array([None, *values], typ if kind in ("string", "boolean", "float", "double") else None)
    col = plain if plain.type == typ else plain.cast(pa.int32() if kind == "date" else pa.int64() if "time" in kind else typ).cast(typ)
    rows = RowCodec([kind]).encode([col], np.zeros(len(col), np.int64))
    assert len(set(rows)) == len(rows)
    (back,) = RowCodec([kind]).decode(rows)
    assert back.equals(col)
    if kind not in ("string",):
        assert sorted(rows) == rows
    else:
        assert [RowCodec([kind]).decode([x])[0][0].as_py() for x in sorted(rows)][1:] == sorted(values, key=str.encode)
