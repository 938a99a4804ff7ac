"""Each operator against a brute-force version or a round trip, and on rows that break careless code."""

import collections
import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size long, block int"
WORD = r"[^\x20\x09-\x0D]+"


def rows_of(texts):
    """Documents with extra columns whose names clash with those that operators use inside."""
    return [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", 7, 1) for i, t in texts]


def awkward():
    """Nulls, empty and long texts, ties, repeated rows, near and exact copies, repeated passages."""
    r = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, base = text(60), text(120)
    near = base.split()
    near[50] = "changed"
    texts = [None, "", " \n\t ", "one", "The End", "the end", base, base, " ".join(near), text(50) + "\n" + passage + "\n" + text(30), text(20) + " " + passage, "a " * 200, "a b " * 100, text(3000), "\n".join(["l1", "l2", "l3", "l4"]), "\n".join(["x", "l1", "l2", "l3", "y", "l1", "l2", "l3"]), "é ü 日本 " * 15, "x<|endoftext|>y, it's  done\n\n", " a　b"]
    out = list(enumerate(texts))
    return rows_of(out + [(6, base), (None, "no id here"), (None, None)])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return (x is not None, x or 0)


# --- substring dedup -----------------------------------------------------------------------------


def brute_substrings(rows, width):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (key(r[0]), r[1] is not None, r[1] or "")):
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - width + 1):
            g = tuple(w[k : k + width])
            if g in seen:
                gone.update(range(k, k + width))
            seen.add(g)
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return collections.Counter(out)


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_substring_dedup(docs, block_bytes):
    from settleforge.llm.substring_dedup import dedup_substrings

    got = dedup_substrings(docs, min_words=20, block_bytes=block_bytes).collect()
    assert collections.Counter((r[0], r[1], r[2], r[3]) for r in got) == brute_substrings([(r[0], r[1]) for r in awkward()], 20)
    for r in got:
        assert r["n_removed"] == sum(x["end"] - x["start"] for x in r["removed"])


def test_substring_dedup_empty(empty):
    from settleforge.llm.substring_dedup import dedup_substrings

    assert dedup_substrings(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), min_size=1, max_size=5), st.integers(2, 8))
def test_safe_symbols_are_shared(lists, width):
    """A window that occurs twice holds no safe symbol that occurs once."""
    import numpy as np

    from settleforge.llm.substring_dedup import recompress

    words = np.array([x * 7919 + 1 for d in lists for x in d], np.uint64)
    row = np.repeat(np.arange(len(lists), dtype=np.int32), [len(d) for d in lists])
    sym, s, e, lo, hi = recompress(words, row, 4)
    count = collections.Counter(sym.tolist())
    places = collections.defaultdict(list)
    for i in range(len(words) - width + 1):
        if row[i] == row[i + width - 1]:
            places[tuple(words[i : i + width].tolist())].append(i)
    for at in places.values():
        if len(at) > 1:
            for i in at:
                assert all(count[int(x)] > 1 for x, a, b in zip(sym, lo, hi, strict=True) if i <= a and b <= i + width)


# --- near duplicates -----------------------------------------------------------------------------


def brute_near(rows):
    sets = collections.defaultdict(set)
    for i, t in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets[i] |= s
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(docs):
    from settleforge.llm.near_dedup import near_duplicates

    got = near_duplicates(docs).collect()
    want = brute_near([(r[0], r[1]) for r in awkward()])
    assert len(got) == len(awkward())
    assert {r[0]: (r[1], r[2]) for r in got if r[0] is not None} == want
    assert all(r["kept"] == (r["component_id"] == r[0]) for r in got if r[0] is not None)
    assert all(r["kept"] and r["component_id"] is None for r in got if r[0] is None)


def test_near_duplicates_chains(spark, monkeypatch):
    """A long chain of texts, each like its neighbours only, and chunks far smaller than a bucket."""
    from settleforge.llm import near_dedup

    monkeypatch.setattr(near_dedup, "CHUNK", 4)
    words = [f"c{k}" for k in range(400)]
    texts = [(k, " ".join(words[3 * k : 3 * k + 60])) for k in range(40)]
    df = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = {r[0]: (r[1], r[2]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == brute_near(texts)


def test_near_duplicates_empty(empty):
    from settleforge.llm.near_dedup import near_duplicates

    assert near_duplicates(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1))
def test_parity_bounds_the_difference(a, b):
    import numpy as np

    from settleforge.llm.near_dedup import folded, parity

    x, y = (np.frombuffer(parity(np.array(sorted(s), np.uint64) * np.uint64(7919)), np.uint64) for s in (a, b))
    n = min(len(x), len(y))
    assert int(np.bitwise_count(folded(x, n) ^ folded(y, n)).sum()) <= len(a ^ b)


# --- line dedup ----------------------------------------------------------------------------------


def brute_lines(rows, least):
    """Every run of lines that are not blank, from every line to every later one, that has enough words and starts earlier too."""
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: key(r[0])):
        lines = [] if t is None else t.split("\n")
        own = [(k, x, len(re.findall(WORD, x))) for k, x in enumerate(lines) if re.search(WORD, x)]
        gone = set()
        for a in range(len(own)):
            for z in range(a, len(own)):
                if sum(n for _, _, n in own[a : z + 1]) >= least:
                    g = tuple(x for _, x, _ in own[a : z + 1])
                    if seen.setdefault(g, (i, a)) != (i, a):
                        gone.update(k for k, _, _ in own[a : z + 1])
        for (k, _, _), (m, _, _) in zip(own, own[1:], strict=False):
            if {k, m} <= gone:
                gone.update(range(k, m))
        out[i] = (len(lines), len(gone), None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


@pytest.mark.parametrize("least", [1, 3, 5])
def test_line_dedup(docs, least):
    from settleforge.llm.line_dedup import dedup_lines

    rows = [(r[0], r[1]) for r in awkward() if r[0] is not None and r[0] != 6]
    got = {r[0]: r for r in dedup_lines(docs.where("doc_id <> 6"), min_words=least, carry=("source", "id")).collect()}
    assert {i: (r["n_lines"], r["n_removed"], r["kept_text"]) for i, r in got.items()} == brute_lines(rows, least)
    assert got[15]["id"] == "x"


def test_line_dedup_random_lines(spark):
    from settleforge.llm.line_dedup import dedup_lines

    r = random.Random(11)
    lines = ["", " ", "a", "b c", "d e f", "g h i j k", "l m n o p q r"]
    texts = [(i, "\n".join(r.choice(lines) for _ in range(r.randrange(1, 12)))) for i in range(60)]
    got = {x[0]: (x["n_lines"], x["n_removed"], x["kept_text"]) for x in dedup_lines(spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)).collect()}
    assert got == brute_lines(texts, 5)


def test_line_dedup_whole_table(docs, empty):
    from settleforge.llm.line_dedup import dedup_lines

    out = collections.Counter(map(tuple, dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "kept_text").collect()))
    # Rows equal in id and text cannot be told apart: both keep what one would.
    assert sum(out.values()) == len(awkward()) and max(out.values()) == 2
    assert out[None, 1, 0, "no id here"] == out[None, 0, 0, None] == 1
    assert dedup_lines(empty).count() == 0


def test_line_dedup_single_lines(spark):
    from settleforge.llm.line_dedup import dedup_lines

    texts = [(1, "a b\nc\n\nd"), (2, "z\na b\ny"), (3, "d\nc"), (4, "q\n\nr\nq\n\nr\n"), (5, "p\n\n\nd"), (6, "a b"), (7, "\n"), (8, "c\n\nd\n "), (9, None), (None, "c\nown")]
    df = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_text"]) for r in dedup_lines(df, min_words=1).collect()}
    # With one word as the least, each line goes by itself, and a blank one between two that go.
    assert got == {None: (2, 0, "c\nown"), 1: (4, 1, "a b\n\nd"), 2: (3, 1, "z\ny"), 3: (2, 2, ""), 4: (7, 3, "q\n\nr\n"), 5: (4, 1, "p\n\n"), 6: (1, 1, ""), 7: (2, 0, "\n"), 8: (4, 3, " "), 9: (0, 0, None)}
    long = [(1, "one line of six words here\nx"), (2, "y\none line of six words here\nz"), (3, "x")]
    got = {r["doc_id"]: r["kept_text"] for r in dedup_lines(spark.createDataFrame(rows_of(long), SCHEMA)).collect()}
    assert got == {1: long[0][1], 2: "y\nz", 3: "x"}


# --- url filter ----------------------------------------------------------------------------------


def test_url_filter(spark):
    from settleforge.llm.url_filter import filter_urls

    pages = [
        (1, "http://a.com/x?y=1", '<a href="https://B.org:8080/z">b</a>'),
        (2, "https://Shop.Example.com/en/1#t", None),
        (3, "https://www.example.com/en/1", ""),
        (4, "http://b.org", '<a href="//shop.example.com/">s</a>'),
        (5, "no scheme", "x"),
        (6, None, None),
        (7, "http://q.net/es/1?a", ""),
        (8, "http://q.net/es", ""),
        (9, "http://lone.org/", '<a href="http://shop.example.com/">s</a>'),
        (None, "http://a.com/", None),
    ]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in filter_urls(df).collect()}
    assert [(got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) for k in (1, 2, 3, 5, 6, 7)] == [("a.com", "/x", "com/", "allow"), ("shop.example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("q.net", "/es/1", "net/es/", "block")]
    assert got[8]["rule"] is None
    # Linked from a trusted host, and so no worse than neutral; the lone host only links to a blocked one.
    assert got[4]["trust"] > 0 and got[9]["verdict"] == "block" and got[9]["distrust"] > 0
    assert filter_urls(df.limit(0)).count() == 0


def test_url_filter_reads_links_of_every_form(spark):
    from settleforge.llm.url_filter import host_links

    html = [
        "<a href='https://a.net/x'>", '<A Href = "//b.net:80/">', "<img SRC=http://u@C.net/p.png>", '<a href="/own">see www.d.org and jquery.min.js</a>',
        '<a href="https://www.e.com/q">', "plain https://www.f.com/z", "<a data-href='no'>", None, "",
    ]
    df = spark.createDataFrame([(f"h{i}.x", t) for i, t in enumerate(html)], "node string, html string")
    got = {(r["src"], r["dst"]): r["n"] for r in host_links(df).collect()}
    assert got == {("h0.x", "a.net"): 1, ("h1.x", "b.net"): 1, ("h2.x", "c.net"): 1, ("h3.x", "www.d.org"): 1, ("h4.x", "www.e.com"): 1}
    long = spark.createDataFrame([("h.x", "<a href='//t.net'>" * 20000)], "node string, html string")
    assert [tuple(r) for r in host_links(long).collect()] == [("h.x", "t.net", 20000)]


def test_url_filter_distrusts_by_single_quotes(spark):
    from settleforge.llm.url_filter import filter_urls

    pages = [(1, "http://q.net/es/1", ""), (2, "http://s.org/", "<a href='http://q.net/'>"), (3, "http://p.org:8080/", '<a Href = "http://q.net:81/">')]
    got = {r["page_id"]: r["verdict"] for r in filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "block"}


def test_url_filter_hub_passes_mass_to_single_links(spark):
    from settleforge.llm.url_filter import FINE, MASS, propagate

    edges = spark.createDataFrame([(0, "hub", "big", 3 * 10**6), (0, "hub", "one", 1), (1, "bad", "big", 3 * 10**6), (1, "bad", "one", 1)], "walk int, src string, dst string, n long")
    seeds = spark.createDataFrame([(0, "hub", 1), (1, "bad", 1)], "walk int, host string, n long")
    got = {(r["walk"], r["host"]): int(r["mass"]) for r in propagate(edges, seeds, 2).collect()}
    out = MASS * FINE * 15 // 100 * 85 // 100
    for walk in (0, 1):
        assert got[walk, "one"] == out // (3 * 10**6 + 1) > 0 and got[walk, "big"] == out * 3 * 10**6 // (3 * 10**6 + 1)
    even = spark.createDataFrame([(0, "hub", f"h{i}", 1) for i in range(600)], "walk int, src string, dst string, n long").selectExpr("walk", "src", "dst", "n * 1000 AS n")
    assert 0 <= out - sum(int(r["mass"]) for r in propagate(even, seeds.where("walk = 0"), 2).where("host <> 'hub'").collect()) < 600


# --- license scan --------------------------------------------------------------------------------


def test_license_scan(docs, empty, spark):
    from settleforge.llm.license_scan import scan_licenses

    texts = rows_of([(1, "x\nLicensed under the APACHE License, Version 2.0.\ny"), (2, "All rights reserved. all RIGHTS-reserved"), (3, "CC BY cc by"), (4, None), (5, ""), (6, "licensed apache"), (7, "Released under the MIT License."), (8, "all rights 1reserved")])
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert (got[1]["labels"], got[1]["base_labels"], got[1]["n_words"]) == ("apache-2.0", "", 10)
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"], got[2]["labels"]) == (2, 0, 3, "reserved")
    assert (got[3]["n_base"], got[3]["base_labels"]) == (2, "cc-by")
    assert all((got[k]["n_words"], got[k]["labels"], got[k]["first_word"], got[k]["score"]) == (0, "", None, 0.0) for k in (4, 5))
    assert got[6]["labels"] == "" and got[7]["labels"] == "mit" and got[8]["n_base"] == 0
    assert scan_licenses(docs).count() == len(awkward()) and scan_licenses(empty).count() == 0


def test_license_scan_wrapped_notices(spark):
    from settleforge.llm.license_scan import TEMPLATES, scan_licenses

    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    isc = "# Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee is hereby granted, provided that the above"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal"
    gpl = " * This program is free software: you can redistribute it and/or modify\n\n * it under the terms of the GNU General Public License as published by"
    texts = [(1, bsd), (2, "x y\n" * 50 + isc), (3, mit), (4, gpl), (5, "\n".join(TEMPLATES["mpl-2.0"].split())), (6, "released " + "x " * 9 + "under\nthe license"), (7, "under the license\nx x x x\nreleased"), (8, "mit\nlicense the")]
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert [got[k]["labels"] for k in range(1, 9)] == ["bsd", "isc", "mit-notice", "gpl,gpl-notice", "mpl-2.0", "", "", ""]
    assert [(m["line"], m["label"]) for m in got[2]["matches"]] == [(50, "isc")] and got[1]["score"] == got[3]["score"] == 1.0


def brute_licenses(text, templates, threshold=0.8):
    """Labels of the templates of which a line, or a window of 1 / threshold times their words, holds enough."""
    out, split = {}, lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    lines, words = [split(x) for x in (text or "").split("\n")], split(text)
    for label, t in templates.items():
        need, span = set(t.split()), -(-len(t.split()) * 5 // 4)
        blocks = lines + [words[i : i + span] for i in range(len(words))]
        best = max([len(need & set(b)) for b in blocks], default=0) / len(need)
        if best >= threshold - 1e-9:
            out[label] = best
    return out


def test_license_scan_like_brute_force(spark):
    from settleforge.llm.license_scan import TEMPLATES, scan_licenses

    r, texts = random.Random(8), []
    for i in range(150):
        w = []
        for _ in range(r.randrange(1, 4)):
            t = TEMPLATES[r.choice(sorted(TEMPLATES))].split()
            w += ["filler"] * r.randrange(5) + [y for x in t for y in ([x] if r.random() < 0.9 else []) + (["odd"] if r.random() < 0.15 else [])]
        texts.append((i, "".join(x + r.choice(["\n", " ", ", ", " "]) for x in w)))
    got = scan_licenses(spark.createDataFrame(rows_of(texts), SCHEMA), phrases={"no such phrase": "none"}).collect()
    want = {i: brute_licenses(t, TEMPLATES) for i, t in texts}
    assert {x["doc_id"]: (x["labels"], x["score"]) for x in got} == {i: (",".join(sorted(b)), max(b.values(), default=0.0)) for i, b in want.items()}
    assert 20 < sum(map(len, want.values()))


# --- mixing --------------------------------------------------------------------------------------


def test_mixing(spark, docs, empty):
    from settleforge.llm.mixing import mix_sources

    r = random.Random(3)
    rows = [(i, "w " * r.randrange(1, 60), "en", s, 0, "x", 1, 1) for i, s in enumerate(["a"] * 400 + ["b"] * 40 + [None] * 60 + ["c"])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix_sources(df).collect()
    by, biggest = collections.defaultdict(int), max(x["size"] for x in out)
    for x in out:
        by[x["source"]] += x["taken"]
        assert x["taken"] in (0, x["size"], 2 * x["size"])
    target = {x["source"]: x["target"] for x in out}
    size = {x["source"]: x["source_size"] for x in out}
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    assert all(abs(by[s] - target[s]) <= biggest for s in by) and all(target[s] <= 2 * size[s] + 1e-9 for s in by)
    assert sorted((x["doc_id"], x["taken"]) for x in mix_sources(df.repartition(7)).collect()) == sorted((x["doc_id"], x["taken"]) for x in out)
    assert mix_sources(docs).count() == len(awkward()) and mix_sources(empty).count() == 0


# --- quality -------------------------------------------------------------------------------------


def brute_measures(x):
    x = x or ""
    w, seen, dup = re.findall(WORD, x), set(), 0
    for line in x.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = collections.Counter(grams)
    again = {k for i, g in enumerate(grams) if n[g] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(again)


def test_quality(docs, empty):
    from settleforge.llm.quality import RULES, Texts, judge_quality
    from settleforge.llm.textops import column_bytes

    got = judge_quality(docs, carry=("text", "size")).collect()
    assert len(got) == len(awkward())
    for r in got:
        m = brute_measures(r["text"])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == m
        assert r["base_failed"] == (m[0] < 20 or 100 * m[4] > 30 * m[0])
        t = Texts(*column_bytes(pa.array([r["text"]], pa.string())))
        assert r["kept"] == (not any(rule.fails(t)[0] for rule in RULES))
    short = judge_quality(docs, measures=False).select("doc_id", "kept").collect()
    assert collections.Counter(map(tuple, short)) == collections.Counter((r["doc_id"], r["kept"]) for r in got)
    assert judge_quality(empty).count() == 0


# --- Matroska ------------------------------------------------------------------------------------


def test_matroska_round_trip(docs, empty):
    from settleforge.llm.matroska import packet_table, store_texts

    out = store_texts(docs)
    got = {r["doc_id"]: r for r in out.where("doc_id <> 6").collect()}
    for i, t, *_ in awkward():
        if i is None or i == 6:
            continue
        raw = (t or "").encode()
        want = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert bytes(got[i]["payload"]) == want and got[i]["n_bytes"] == len(raw)
    packets = packet_table(out.where("doc_id = 13")).orderBy("packet").collect()
    media, load = bytes(got[13]["media"]), bytes(got[13]["payload"])
    assert [p["time"] for p in packets] == [12 * k for k in range(len(packets))]
    assert b"".join(media[p["offset"] : p["offset"] + p["size"]] for p in packets) == load
    assert all(zlib.crc32(media[p["offset"] : p["offset"] + p["size"]]) == p["crc32"] for p in packets)
    from settleforge.llm.matroska import FRAME, parse, write

    read = parse(write(bytes(FRAME * 6000)))
    places = dict(read.clusters)
    assert len(places) > 1 and len(read.cues) == len(places)
    assert all(places[position] == time for time, _, position in read.cues)
    assert store_texts(empty).count() == 0


def read_elements(data):
    """A second reader of EBML, for files whose sizes are all known: (id, body) of each element."""
    at = 0
    while at < len(data):
        n = 9 - data[at].bit_length()
        ident, at = data[at : at + n].hex(), at + n
        n = 9 - data[at].bit_length()
        size = int.from_bytes(data[at : at + n], "big") - (1 << 7 * n)
        at += n
        yield ident, data[at : at + size]
        at += size
    assert at == len(data)


def test_matroska_query_by_another_reader(spark, sf):
    from settleforge.llm.matroska import store_texts
    from settleforge.llm.queries import op8_matroska

    texts = {r[0]: (r[1] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    media = {r[0]: bytes(r[1]) for r in store_texts(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "media").collect()}
    features = collections.defaultdict(set)
    for r in op8_matroska(spark, sf).collect():
        raw, file = texts[r["doc_id"]], media[r["doc_id"]]
        want = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(file), hashlib.sha256(file).hexdigest())
        ((head, _), (segment, body)) = read_elements(file)
        assert (head, segment) == ("1a45dfa3", "18538067")
        frames = []
        for ident, cluster in read_elements(body):
            for kind, block in read_elements(cluster) if ident == "1f43b675" else []:
                if kind == "a3":
                    assert block[0] == 0x81 and block[3] & 0x06 in (0, 4)  # track 1, no lacing or frames of one size
                    load = block[4:] if not block[3] & 0x06 else block[5:]
                    frames.append(load)
        assert b"".join(frames) == want
        features[raw].add(r["feature"])
    assert all(len(x) == 1 for x in features.values()) and len({x for f in features.values() for x in f}) > 100


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=700), min_size=2, max_size=9), st.sampled_from(["xiph", "ebml", "fixed", "none"]))
def test_matroska_lacings(frames, lacing):
    from settleforge.llm import matroska as m

    if lacing == "fixed":
        frames = [f.ljust(700, b"\0") for f in frames]
    if lacing == "none":
        frames = frames[:1]
    head = m._element(m.EBML, m._element(m.DOC_TYPE, b"webm"))
    group = m._element(m.BLOCK_GROUP, m._element(m.BLOCK, m.lace(2, 5, frames, lacing)) + m._element(m.REFERENCE_BLOCK, b"\x01"))
    # A cluster of unknown size inside a segment of unknown size, and another one behind it.
    unknown = b"\x01" + b"\xff" * 7
    cluster = m._id(m.CLUSTER) + unknown + m._uint(m.TIMESTAMP, 100) + group
    data = head + m._id(m.SEGMENT) + unknown + cluster + m._element(m.CLUSTER, m._uint(m.TIMESTAMP, 200) + m._element(m.SIMPLE_BLOCK, m.lace(1, -3, [b"q"])))
    out = m.parse(data)
    assert [data[o : o + n] for o, n in zip(out.offset, out.size, strict=True)] == [*frames, b"q"]
    assert out.time[0] == 105 and out.time[-1] == 197 and out.key == [False] * len(frames) + [True]
    assert out.track == [2] * len(frames) + [1]


def test_matroska_broken_files(spark):
    from settleforge.llm.matroska import packet_table, write

    whole = write(b"\0" * 5760)
    df = spark.createDataFrame([(1, whole), (2, whole[:-3]), (3, b"RIFF...."), (4, None), (5, b"")], "doc_id long, media binary")
    got = {r["doc_id"]: r["error"] for r in packet_table(df).collect()}
    assert got[1] is None and all(got[k] for k in (2, 3, 4, 5))


# --- packing -------------------------------------------------------------------------------------


def test_packing(docs, empty):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from settleforge.llm.packing import pack_documents

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = pack_documents(docs, path).collect()
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    for i, t, *_ in awkward():
        if i is None or i == 6:
            continue
        want = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        ids = [x for r in sorted(pieces[i], key=lambda r: r["start"]) for x in np.frombuffer(r["ids"], "<u4").tolist()]
        assert ids == want and all(r["doc_tokens"] == len(want) for r in pieces[i])
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack_documents(empty, path).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=60))
def test_assign_fills_sequences(sizes):
    import numpy as np

    from settleforge.llm.packing import assign

    pieces = assign(np.array(sizes, np.int64), 512)
    for d, n in enumerate(sizes):
        own = sorted(p[1:3] for p in pieces if p[0] == d)
        assert sum(x[1] for x in own) == n and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
    used = collections.Counter()
    for p in pieces:
        used[p[3]] += p[2]
    assert all(n <= 512 for n in used.values()) and len(used) == -(-sum(sizes) // 512) or sum(sizes) == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab.,'! \n\té1×÷ |<>", max_size=40), max_size=5))
def test_units_tokenise_like_whole_texts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    from settleforge.llm.packing import unit_tokenizer
    from settleforge.llm.textops import column_bytes

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, at = unit_tokenizer(path).encode(*column_bytes(pa.array(texts, pa.string())))
    tok = Tokenizer.from_file(path)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


# --- toxicity ------------------------------------------------------------------------------------


def test_toxicity(spark, empty, docs):
    from settleforge.llm.toxicity import score_toxicity

    r = random.Random(1)
    words = [f"w{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(1500):
        t = [r.choice(words) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            t[r.randrange(40)] = r.choice(["Idiot,", "scum"])
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    df, lab = spark.createDataFrame(rows_of(rows), SCHEMA), spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    got = {x["doc_id"]: x for x in score_toxicity(df, lab).collect()}
    assert all(x["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, x in got.items())
    held = [i for i, x in got.items() if x["held_out"]]
    assert sum(got[i]["predicted"] == labels[i][1] for i in held) / len(held) > 0.98
    assert score_toxicity(docs, lab.limit(0)).where("score <> 0.5").count() == 0
    assert score_toxicity(empty, lab).count() == 0
    assert score_toxicity(docs, lab).where("score IS NULL OR score < 0 OR score > 1").count() == 0


def plain_ftrl(data, epochs, alpha, beta, l1):
    """FTRL-proximal by the book, one coordinate at a time; the intercept is not regularised."""
    import math

    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(k):
        bound = 0.0 if k == "intercept" else l1
        if abs(z[k]) <= bound:
            return 0.0
        return -(z[k] - math.copysign(bound, z[k])) / ((beta + math.sqrt(n[k])) / alpha)

    for _ in range(epochs):
        for features, y in data:
            w = {k: weight(k) for k in [*features, "intercept"]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for k, x in w.items():
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * x
                n[k] += g * g
    return weight


def test_ftrl_is_the_plain_one(spark):
    from settleforge.llm.toxicity import BITS, Ftrl, fit

    r = random.Random(4)
    rows = [(i, " ".join(r.choice("abcdefgh") for _ in range(6)), i % 3 == 0) for i in range(120)]
    df = spark.createDataFrame([(i, t + (" bad" if y else ""), int(y)) for i, t, y in rows], "doc_id long, text string, label int")
    got = fit(df, max_train=1000)
    order = [x[0] for x in df.select("doc_id").orderBy(F.xxhash64("doc_id")).collect()]
    data = []
    for i in order:
        t = (rows[i][1] + (" bad" if rows[i][2] else "")).split()
        data.append(({*t, *zip(t, t[1:], strict=False), *((a, None, b) for a, b in zip(t, t[2:], strict=False))}, int(rows[i][2])))
    m = Ftrl()
    weight = plain_ftrl(data, 3, m.alpha, m.beta, m.l1)
    want = sorted(x for x in (weight(k) for k in {k for f, _ in data for k in f}) if x)
    assert abs(got[2**BITS] - weight("intercept")) < 1e-9
    have = sorted(w for k, w in got.items() if k != 2**BITS)
    assert len(have) == len(want) and max(abs(a - b) for a, b in zip(have, want, strict=True)) < 1e-9


def test_toxicity_bounds_rows(spark):
    """One labelled id that stands a thousand times, clashing names, and a bound far below that."""
    from settleforge.llm.toxicity import score_toxicity

    rows = [(2, f"text {k}", 9, 9, "y") for k in range(1000)] + [(3, "scum", 9, 9, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int, _i int, toxic string")
    labels = spark.createDataFrame([(2, 0, 5, "t"), (2, 0, 5, "t"), (3, 1, 5, "t")], "doc_id long, toxic int, label int, text string")
    assert score_toxicity(df, labels, max_train=10).count() == 1001


# --- hashes --------------------------------------------------------------------------------------


def thue_morse():
    """Two texts on which every polynomial hash modulo a power of two agrees, whatever its base."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hashes_are_not_linear(spark):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from settleforge.llm import textops
    from settleforge.llm.near_dedup import near_duplicates
    from settleforge.llm.packing import pack_documents
    from settleforge.llm.quality import judge_quality
    from settleforge.llm.substring_dedup import dedup_substrings

    x, y = thue_morse()
    for seed in (0, 1):
        h = textops.hash_spans(*textops.column_bytes(pa.array([x + y]))[:1], np.array([0, 1024]), np.array([1024, 2048]), seed)
        assert h[0] != h[1]
    pad = " ".join(f"w{k}" for k in range(19))
    df = spark.createDataFrame(rows_of([(1, f"{pad} {x}"), (2, f"{pad} {y}"), (3, f"{x}\n{y}"), (4, x), (5, y), (6, x)]), SCHEMA)
    assert all(r["n_removed"] == 0 for r in dedup_substrings(df).collect())
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(df.where("doc_id > 3")).collect()} == {4: 4, 5: 5, 6: 4}
    assert all(r["n_dup_lines"] == 0 for r in judge_quality(df).collect())
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in pack_documents(df.where("doc_id IN (4, 5)"), path).collect()}
    assert ids == {k: [*tok.encode(t, add_special_tokens=False).ids, 1] for k, t in ((4, x), (5, y))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=12))
def test_hashes_tell_spans_apart(parts):
    import numpy as np

    from settleforge.llm.textops import hash_spans

    at = np.cumsum([0, *map(len, parts)])
    for seed in (0, 1):
        h = hash_spans(np.frombuffer(b"".join(parts), np.uint8), at[:-1], at[1:], seed).tolist()
        assert len(set(h)) == len(set(parts)) == len(set(zip(h, parts, strict=True)))


# --- names ---------------------------------------------------------------------------------------

#: Names that operators and stages use inside or return.
NAMES = ["id", "row", "lines", "hashes", "starts", "kept", "kept_text", "n_lines", "n_removed", "n_words", "base_failed", "copies", "copy", "_id", "_source", "_copy", "_row", "_text", "_i", "_d", "_t", "_y", "_s", "_c0", "_0", "m0", "h", "f", "at", "w1", "label", "score", "component", "digest", "head", "key", "a", "b", "block", "bucket", "places", "size", "target", "full", "lo", "take", "words", "doc", "c0", "c1", "salt", "text_", "late_id", "late_row", "source_size"]


def test_clashing_names(spark):
    import corpus_pipeline as p
    import public_tokenizers

    from settleforge.llm import license_scan, line_dedup, matroska, mixing, near_dedup, packing, quality, substring_dedup, toxicity, url_filter

    rows = [(r[0], r[1], "en", "s", 3, *range(len(NAMES))) for r in awkward()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in NAMES)).repartition(2)
    for name, stage in p.STAGES:
        out = stage(spark, df, "")
        if name != "packing":
            assert out.columns == df.columns, name
            assert all(tuple(r)[5:] == tuple(range(len(NAMES))) for r in out.collect()), name
        else:
            assert out.count() >= len(rows)
    path, n = public_tokenizers.path("byte_bpe_50k.json"), len(rows)
    labels = df.selectExpr("doc_id", "int(doc_id % 2) AS toxic", *NAMES)
    for out in (
        substring_dedup.dedup_substrings(df), near_dedup.near_duplicates(df), line_dedup.dedup_lines(df), license_scan.scan_licenses(df), mixing.mix_sources(df),
        quality.judge_quality(df), matroska.store_texts(df), toxicity.score_toxicity(df, labels), url_filter.filter_urls(df.withColumnRenamed("lang", "url").withColumnRenamed("source", "html"), "doc_id"),
    ):
        assert out.count() == n
    assert packing.pack_documents(df, path).count() >= n


# --- queries and pipeline ------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    from settleforge.llm.queries import op10_toxicity

    sf = "/root/testdata/sf0.1"
    got = op10_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("predicted", "toxic").collect()
    assert sum(a == b for a, b in got) / len(got) > 0.97


def test_queries_meet_their_oracles(spark, sf):
    import duckdb

    from settleforge.llm import queries as q

    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in q.oracle_sql().items():
        want = con.sql(sql)
        df = q.queries()[name](spark, sf).select(*want.columns)
        order = lambda rows: sorted(map(tuple, rows), key=str)
        assert order(df.collect()) == order(want.fetchall()), name


def test_op1_query_digest(spark, sf):
    from settleforge.llm.queries import op1_substring_dedup

    want = brute_substrings([tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()], 20)
    got = {tuple(r) for r in op1_substring_dedup(spark, sf).collect()}
    assert got == {(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in want}


def test_pipeline(spark, sf, tmp_path):
    """Each stage's rows are those that SQL gives for the rows it was given; packing covers every token of its documents once."""
    import duckdb

    import corpus_pipeline as p
    from settleforge.llm import line_dedup, mixing, near_dedup, quality
    from settleforge.llm.storage import Scratch

    docs, scratch = spark.read.parquet(f"{sf}/documents.parquet"), Scratch(spark)
    # Near copies on a line of their own, which only the third stage takes out.
    words = next(t.split() for (t,) in docs.where("length(text) > 1500 AND lang = 'en'").orderBy("doc_id").select("text").collect())[:150]
    near = [(10**7 + k, " ".join([*words[:at], "changed", *words[at + 1 :]])) for k, at in enumerate((20, 60, 100))]
    more = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in near], docs.schema)
    sf = str(tmp_path)
    docs.unionByName(more).write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept, rows = docs.columns, docs, {}
    for name, stage in p.STAGES[:-1]:
        rows[name] = kept.toPandas()
        kept = scratch.write(stage(spark, kept, sf), name)
        assert kept.columns == columns, name
    rows["packing"] = kept.toPandas()

    def sql(module, name):
        with duckdb.connect() as con:
            con.register("documents", rows[name])
            return con.sql(module.oracle()).df()

    ids = lambda name: sorted(rows[name]["doc_id"])
    want = sql(quality, "quality")
    assert ids("line_dedup") == sorted(want[want.kept]["doc_id"]) and len(ids("line_dedup")) < len(ids("quality"))
    want = {r.doc_id: r for r in sql(line_dedup, "line_dedup").itertuples()}
    got = {r.doc_id: r.text for r in rows["near_dedup"].itertuples()}
    for i, r in want.items():
        if i in got:
            assert hashlib.sha256(got[i].encode()).hexdigest() == r.kept_sha256
        else:
            assert r.n_removed > 0
    assert set(got) <= set(want) and all(r.n_chars == len(r.text) for r in rows["near_dedup"].itertuples())
    assert sum(r.n_removed for r in want.values()) > 0
    want = sql(near_dedup, "near_dedup")
    assert ids("mixing") == sorted(want[want.kept]["doc_id"]) and len(ids("mixing")) < len(ids("near_dedup"))
    want = sql(mixing, "mixing")
    assert collections.Counter(ids("packing")) == {
        r.doc_id: r.taken // r.size for r in want.itertuples() if r.taken
    }
    out = p.run(spark, sf).collect()
    pieces = collections.defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    assert set(pieces) == set(ids("packing"))
    copies = collections.Counter(ids("packing"))
    for i, own in pieces.items():
        n = own[0][2]
        covered = collections.Counter(t for start, length, _ in own for t in range(start, start + length))
        assert covered == {t: copies[i] for t in range(n)}


def test_pipeline_on_awkward_rows(spark, docs, empty):
    import corpus_pipeline as p

    for df in (docs, empty):
        for _, stage in p.STAGES:
            assert stage(spark, df, "").count() >= 0
