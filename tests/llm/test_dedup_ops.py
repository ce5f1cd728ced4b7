"""Near-dedup, suffix dedup and components against brute force on full sets and all windows."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexalign.llm import near_dedup as ND
from lexalign.llm import suffix_dedup as SD
from lexalign.llm import words as W
from lexalign.llm.components import components
from lexalign.llm.tables import Scratch, maybe_in, salted_join

from hostile import frame, lower, prose, rows


def _sets(data, n):
    out = []
    for _, t in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        out.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def _family(seed, copies, edits):
    r = random.Random(seed)
    base = prose(seed, 120).split()
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates(spark):
    big = 1 << 62
    data = rows() + [(100 + k, t) for k, t in enumerate(_family(21, 40, 3) + _family(22, 12, 7))]
    sets, up = _sets(data, 4), list(range(len(data)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    ids = [big if i is None else i for i, _ in data]
    least = {}
    for k in range(len(data)):
        least[find(k)] = min(least.get(find(k), big), ids[k])
    want = Counter()
    for k, (i, _) in enumerate(data):
        first = least[find(k)] if sets[k] else ids[k]
        want[i, len(sets[k]), None if first == big else first, first == ids[k]] += 1
    out = ND.near_duplicates(frame(spark, data), W.NOT_SPACE, 4, 80)
    assert Counter(map(tuple, out.collect())) == want
    kept = ND.keep_one(frame(spark, data), W.NOT_SPACE, 4, 80)
    assert kept.columns == frame(spark).columns
    groups = len({find(k) for k in range(len(data)) if sets[k]}) + sum(not s for s in sets)
    assert kept.count() == groups
    assert ND.near_duplicates(frame(spark, []), W.NOT_SPACE, 4, 80).count() == 0


@pytest.mark.parametrize("span, block", [(ND.SPAN, ND.BLOCK), (500, 300_000)])
def test_near_duplicates_of_a_large_family(spark, monkeypatch, span, block):
    monkeypatch.setattr(ND, "SPAN", span)
    monkeypatch.setattr(ND, "BLOCK", block)
    r = random.Random(41)
    base, new, texts, kept = [f"b{k}" for k in range(603)], iter(range(10**9)), [], []
    for k in range(2500):
        w = list(base)
        for p in r.sample(range(603), r.randint(12, 18) if k else 0):
            w[p] = f"e{next(new)}"
        texts.append((k, " ".join(w)))
        kept.append([w[p:p + 4] == base[p:p + 4] for p in range(600)])  # new words never meet again
    both = np.array(kept, np.float32) @ np.array(kept, np.float32).T
    links = np.argwhere(np.triu(100 * both >= 80 * (1200 - both), 1))
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links.tolist():
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    want = {k: find(k) for k in range(len(texts))}
    assert 1 < len(set(want.values())) < len(texts)
    got = {x.doc_id: x.component_id for x in ND.near_duplicates(frame(spark, texts), W.NOT_SPACE, 4, 80).collect()}
    assert got == want


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(10**9), 0) for _ in range(30)] + [(k * 7919 % 1009, (k + 1) * 7919 % 1009) for k in range(40)] + [(5, 5)]
    up = {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up.setdefault(a, a), up.setdefault(b, b)
        up[find(a)] = find(b)
    got = {x.node: x.comp for x in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "t").collect()}
    nodes = [n for n in got]
    assert set(nodes) >= {a for a, b in edges if a != b}
    for x in nodes[:20]:
        for y in nodes[:20]:
            assert (got[x] == got[y]) == (find(x) == find(y))


def test_bitmap_filter_loses_nothing(spark):
    keys = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    some = maybe_in(spark.range(0, 5000).withColumnRenamed("id", "k"), keys, "k")
    assert some.join(keys, "k").count() == keys.count() and some.count() < 800


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_broadcasts_no_exploded_table(spark, how):
    scratch = Scratch(spark, "t")
    rows = scratch.save(spark.range(3000).selectExpr("id", "if(id % 50 = 0, null, id % 700) as k"), f"rows_{how}")
    some = scratch.save(spark.range(600).selectExpr("id as k", "id * 3 as v"), f"groups_{how}")
    for groups in (some, some.groupBy("k").agg(F.max("v").alias("v"))):  # sized by its files, and by what was shuffled
        out = salted_join(rows, groups, ["k"], "id", how=how)
        want = Counter((i % 700 if i % 50 else None, i, i % 700 * 3 if i % 50 and i % 700 < 600 else None) for i in range(3000))
        got = Counter(map(tuple, out.select("k", "id", "v").collect()))
        assert got == (want if how == "left" else Counter({x: n for x, n in want.items() if x[2] is not None}))
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()  # as it ran


@pytest.mark.parametrize("together", [2, 2000])
def test_repeated_bytes(spark, together):
    size = 120
    data = rows() + [(200 + k, t) for k, t in enumerate(_family(31, 12, 2))]
    raw = [(t or "").encode() for _, t in data]
    seen = Counter(b[k:k + size] for b in raw for k in range(len(b) - size + 1))
    want = Counter()
    for (i, _), b in zip(data, raw):
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        want[i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    out = SD.remove_repeats(frame(spark, data), size=size, batches=3, together=together).drop("spans")
    assert Counter(map(tuple, out.collect())) == want
    if together == 2:
        assert SD.remove_repeats(frame(spark, []), size=size).count() == 0


def _spans(data, size):
    """Brute force: for each text of one row, the set of bytes that go."""
    raw = {t.encode() for t in data}
    seen = Counter(b[k:k + size] for b in raw for k in range(len(b) - size + 1))
    out = {}
    for b in raw:
        gone = {x for k in range(len(b) - size + 1) if seen[b[k:k + size]] > 1 for x in range(k, k + size)}
        if gone:
            out[len(b), hashlib.sha256(bytes(b[x] for x in sorted(gone))).hexdigest()] = len(gone)
    return out


@pytest.mark.parametrize("hot", [80, 240])
def test_repeated_bytes_of_large_heads(spark, hot):
    """400 bytes; near copies whose heads are cut over several parts: what is written has fewer rows than contexts."""
    data = _family(41, hot, 2) + _family(42, 6, 3) + [prose(43, 40) + t for t in _family(41, 6, 1)]
    scratch = Scratch(spark, "t")
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(data)], "doc_id long, text string")
    keys = spark.createDataFrame([(t, len(t.encode())) for t in data], "text string, n int").selectExpr("xxhash64(text) tk", "n", "text")
    got = {}
    for x in SD.repeated_spans(docs, scratch, 400, 2, 30).join(keys, ["tk", "n"]).collect():
        b = x.text.encode()
        gone = {y for s in x.spans for y in range(s.start, s.end)}
        if gone:
            got[len(b), hashlib.sha256(bytes(b[y] for y in sorted(gone))).hexdigest()] = len(gone)
    assert got == _spans(data, 400)
    contexts = scratch.load("contexts").where("deals > 1").distinct().count()
    assert contexts > hot
    for name in os.listdir(scratch.path.removeprefix("file:")):
        if name not in ("contexts", "met", "want", "suffixes", "copies"):
            assert scratch.load(name).count() <= contexts
