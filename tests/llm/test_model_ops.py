"""Katz scores, toxicity grammar, packing, WARC and the pipeline."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexalign.llm import bpe
from lexalign.llm import katz as KZ
from lexalign.llm import packing as PK
from lexalign.llm import toxicity as TX
from lexalign.llm import warc as WA
from lexalign.llm import words as W
from lexalign.llm.queries import tokenizer_spec


from hostile import SF_SMALL, frame, lower, prose, rows


def test_katz_is_the_definition(spark):
    data = rows()
    toks = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for _, t in data]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in data]
    train = [t for t, o in zip(toks, out) if not o]
    c = Counter(w for t in train for w in t)
    total, kinds = sum(c.values()), len(c)
    often = {w for w in c if c[w] * KZ.HISTORIES >= max(total, 2 * KZ.HISTORIES) and w is not None}

    def history(t):
        return ["<s>"] + [w if w in often else "" for w in t[:-1]]

    pairs, after = Counter(), Counter()
    for t in train:
        for h, w in zip(history(t), t):
            if h:
                pairs[h, w] += 1
                after[h] += 1
    n1, n2 = Counter(c.values()), Counter(pairs.values())
    d1, d2 = (KZ.discounts({r: n[r] for r in range(1, KZ.K + 2)}) for n in (n1, n2))

    def d(table, r):
        return table[r - 1] if r <= KZ.K else 1

    kept = sum(d(d1, r) * r for r in c.values())
    unseen = max(1, n1[1] ** 2 / (2 * max(1, n1[2])))

    def p(w):
        return d(d1, c[w]) * c[w] / total if c[w] else (1 - kept / total) / unseen

    def seen(h, w):
        return d(d2, pairs[h, w]) * pairs[h, w] / after[h] * (1 - 0.5 / after[h])

    alpha = {h: (1 - sum(seen(*x) for x in pairs if x[0] == h)) / (1 - sum(p(w) for g, w in pairs if g == h)) for h in after}
    # every distribution adds up to one
    assert sum(p(w) for w in c) + unseen * p("never seen") == pytest.approx(1)
    for h in list(after)[:5]:
        rest = 1 - sum(p(w) for g, w in pairs if g == h)
        assert sum(seen(*x) for x in pairs if x[0] == h) + alpha[h] * rest == pytest.approx(1)
    want = Counter()
    for (i, _), t, o in zip(data, toks, out):
        base = sum(math.log10((c[w] + 1) / (total + 1 * (kinds + 1))) for w in t)
        score = sum(math.log10(p(w) if not h else seen(h, w) if pairs[h, w] else alpha[h] * p(w)) for h, w in zip(history(t), t))
        want[i, o, len(t), sum(c[w] > 0 for w in t), total, round(base, 6), round(score, 6)] += 1
    got = KZ.score(frame(spark), KZ.held_out(F.col("doc_id"), 7, 2)).collect()
    assert Counter((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert KZ.score(frame(spark, []), KZ.held_out(F.col("doc_id"), 7, 2)).count() == 0


@pytest.mark.parametrize("listed", [KZ.HISTORIES, 20])
def test_katz_counts_every_history(spark, monkeypatch, listed):
    monkeypatch.setattr(KZ, "HISTORIES", listed)
    data = rows() + [(100 + k, prose(k % 7, 40 + k)) for k in range(40)]
    toks = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for _, t in data]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in data]
    train = [t for t, o in zip(toks, out) if not o]
    c = Counter(w for t in train for w in t)
    pairs = Counter(x for t in train for x in zip(["<s>", *t[:-1]], t))
    after = Counter(h for t in train for h in ["<s>", *t[:-1]])
    n1, n2 = Counter(c.values()), Counter(pairs.values())
    d1, d2 = ([*KZ.discounts({r: n[r] for r in range(1, KZ.K + 2)}), 1] for n in (n1, n2))
    total = sum(c.values())
    left = 1 - sum(d1[min(r, 6) - 1] * r for r in c.values()) / total
    unseen = max(1, n1[1] ** 2 / (2 * max(1, n1[2])))

    def p(w):
        return d1[min(c[w], 6) - 1] * c[w] / total if c[w] else left / unseen

    def seen(h, w):
        return d2[min(pairs[h, w], 6) - 1] * pairs[h, w] / after[h] * (1 - 0.5 / after[h])

    alpha = {h: (1 - sum(seen(*x) for x in pairs if x[0] == h)) / (1 - sum(p(w) for g, w in pairs if g == h)) for h in after}
    assert any(after[h] == 1 for t, o in zip(toks, out) if o for h in t[:-1])  # a rare history counts
    want = Counter()
    for (i, _), t, o in zip(data, toks, out):
        score = sum(math.log10(seen(h, w) if pairs[h, w] else alpha.get(h, 1) * p(w)) for h, w in zip(["<s>", *t[:-1]], t))
        want[i, o, len(t), round(score, 6)] += 1
    got = KZ.score(frame(spark, data), KZ.held_out(F.col("doc_id"), 7, 2), every=True).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, round(r.score, 6)) for r in got) == want
    assert KZ.score(frame(spark, []), KZ.held_out(F.col("doc_id"), 7, 2), every=True).count() == 0


def test_katz_deals_wide_batches(spark):
    """More texts in a batch than document numbers have values."""
    n = 70_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 97, F.lit(" v"), F.col("id") % 89).alias("text"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}

    def scores():
        return {r.doc_id: round(r.score, 9) for r in KZ.score(docs.coalesce(1), KZ.held_out(F.col("doc_id"), 7, 2), every=True).collect()}

    want = scores()
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200000")
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        got = scores()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert len(want) == n and got == want


def test_katz_groups_lack_no_rows():
    none, two = np.empty(0), np.arange(2)
    whole = KZ._pack(KZ._DONE, two, np.array([5, 6]), np.array([3, 4]), np.array([1]), two, np.array([0.5, 1]), np.array([-1, -2.0]))
    part = KZ._pack(KZ._DONE, two[1:], none, none, none, two[1:], np.array([2.0]), np.array([-4.0]))

    def gather(*blobs):
        b = pa.RecordBatch.from_arrays([pa.array([7] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())], ["source", "blob"])
        return [tuple(r.values())[1:] for x in KZ._gather(iter([b])) for r in x.to_pylist()]

    assert gather(part, whole) == [(5, 1, 3, 0, 0.5, -1.0), (6, 1, 4, 2, 3.0, -6.0)]
    assert gather(whole, part, whole, part) == [(5, 2, 6, 0, 1.0, -2.0), (6, 2, 8, 4, 6.0, -12.0)]  # two equal groups
    for blobs in ([whole], [part], [whole, part, part]):
        with pytest.raises(ValueError):
            gather(*blobs)


def test_clause_patterns():
    insult, target, no, said = TX.INSULT, TX.TARGET, TX.NEGATION, TX.REPORT
    assert TX.clause_patterns([insult]) == [0]
    assert TX.clause_patterns([target, 0, insult]) == TX.clause_patterns([insult, 0, target]) == [4]
    assert TX.clause_patterns([no, insult]) == [1] and TX.clause_patterns([no, 0, 0, 0, 0, 0, insult]) == [0]
    assert TX.clause_patterns([said, no, target, insult, TX.THREAT]) == [7, 15]
    assert TX.clause_patterns([0, target, no]) == []


def test_clause_patterns_are_their_definition():
    rng = np.random.default_rng(3)
    for _ in range(500):
        c = rng.choice(6, rng.integers(0, 25), p=[0.4, 0.15, 0.1, 0.1, 0.15, 0.1]).tolist()
        want = []
        for i, x in enumerate(c):
            if x not in (TX.INSULT, TX.THREAT):
                continue
            # a cause counts while its scope is not used up; reported speech holds for the rest of the clause
            no = TX.NEGATION in c[max(0, i - TX.SCOPE + 1):i]
            target = TX.TARGET in c[max(0, i - TX.SCOPE + 1):i + TX.SCOPE]
            want.append((8 if x == TX.THREAT else 0) + 4 * target + 2 * (TX.REPORT in c[:i]) + no)
        assert TX.clause_patterns(c) == want


def test_toxicity_learns_markers_and_keeps_clean_texts(spark):
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        docs.append((k, prose(k, 30) + (f". he is a blurgh{k % 17}, friend" if bad else f". he is a nice{k % 17}, friend")))
        labels.append((k, 1 if bad else 0))
    frame_ = frame(spark, docs + [(None, None), (9001, "")])
    lab = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    held = TX.held_out(F.col("doc_id"))
    got = {r.doc_id: r.score for r in TX.score(frame_, TX.train(frame_, lab, held)).collect()}
    assert len(got) == 402 and all(0 <= s <= 1 for s in got.values())
    out = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((got[k] >= 0.5) == (k % 4 == 0) for k in out) >= 0.95 * len(out)
    none = TX.train(frame(spark, []), lab.limit(0), held)
    kept = TX.keep(frame(spark), none, 0.5)
    assert kept.columns == frame(spark).columns and kept.count() == len(rows()) - 1  # the insult goes


def test_ids_are_the_tokenizers_ids():
    enc = bpe.Encoder(tokenizer_spec())
    texts = [t for _, t in rows() if t] + ["It's 12ab l'Été <|endoftext|>x ''s ×÷ÀÉß Ω İ é \x0bx\x1cy\u0085z", "don''t !!'ll"]
    for s in W.slices(pa.array(texts), 3000):
        ids, bounds = enc.encode(s)
        for k in range(len(s)):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == enc.tok.encode(texts[s.first + k], add_special_tokens=False).ids


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 300), max_size=20))
def test_patterns_cover_the_demand(demand):
    plan = PK.patterns(demand, 32)
    used = Counter()
    for n, counts in plan:
        assert n > 0 and sum(z * k for z, k in counts.items()) <= 32
        for z, k in counts.items():
            used[z] += n * k
    assert used == Counter({z: n for z, n in demand.items() if n})
    assert sum(n for n, _ in plan) <= 1.25 * sum(z * n for z, n in demand.items()) / 16 + 40


def test_packing(spark):
    enc = bpe.Encoder(tokenizer_spec())
    got = PK.pack(frame(spark), tokenizer_spec()).collect()
    want = Counter()
    for i, t in rows():
        ids = enc.tok.encode(t or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), 2048):
            piece = ids[a:a + 2048]
            want[i, a, len(piece), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece)), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 2048
    assert PK.pack(frame(spark, []), tokenizer_spec()).count() == 0


def test_warc_round_trip(spark):
    pages = [(5, "http://a.example/x", "<p>one</p>"), (3, "https://WWW.a.example:443/x#f", "<p>one</p>"), (9, "http://a.example/x", "é\r\n\r\nWARC/1.1\r\n"),
             (9, "http://a.example/x", "é\r\n\r\nWARC/1.1\r\n"), (None, None, None), (12, "", ""), (13, "http://b.example/a b?q=1", "<p>one</p>"),
             (14, "http://c.example", "z" * 50_000)]
    df = spark.createDataFrame([(*p, "?") for p in pages], "page_id long, url string, html string, key string").repartition(3)
    store = WA.archive(df)
    out = WA.read_records(WA.lookup(spark, df, store), store).collect()
    least = {}
    for i, _, t in pages:
        least[t or ""] = min(least.get(t or "", 1 << 62), 1 << 62 if i is None else i)
    want = Counter()
    for i, _, t in pages:
        raw, ref = (t or "").encode(), least[t or ""]
        first = ref == (1 << 62 if i is None else i)
        want[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else ref] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    assert {r.payload for r in out if r.record_type == "response"} == {t or "" for _, _, t in pages}
    one = WA.lookup(spark, df.where("page_id = 13"), store)
    assert one.count() == 1 and WA.url_key("https://u@Blog.Example.com:8080/a?b#c") == "com,example,blog:8080)/a?b"
    empty = WA.archive(df.limit(0))
    assert WA.read_records(WA.lookup(spark, df, empty), empty).count() == 0


def test_pipeline_stages_keep_rows_and_columns(spark):
    import corpus_pipeline as P

    docs = frame(spark)
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    assert [name for name, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_is_the_chain_of_its_definitions(spark, tmp_path):
    import corpus_pipeline as P

    alnum, mark = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "a line that several documents have in common"
    base, passage = prose(21, 120), prose(22, 14)
    near = " ".join(["other", *base.split()[1:]])
    docs = [(1, base), (2, near), (3, prose(23, 60) + " " + passage + " " + prose(24, 40)), (4, f"{mark}\n{prose(25, 50)}"),
            (5, f"{prose(26, 50)}\n {mark.upper()} \n{prose(27, 20)}"), (6, None), (7, ""), (8, "two words"), (9, "Two words"),
            (10, "you are an idiot"), (11, f"{mark}\n{base}"), (12, prose(28, 4000)), (13, "you are an idiot, said nobody"), (14, mark)]
    items = [("7", passage), ("8", None), ("9", "too rare to occur")]
    spark.createDataFrame([(i, t, len(t or "")) for i, t in docs], "doc_id long, text string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    left = {i: t or "" for i, t in docs if i not in (10, 13)}  # by the fixed weights, as there are no labels
    keys: dict[str, set] = {}
    for i, t in left.items():
        for x in t.split("\n"):
            keys.setdefault(lower(x.strip()), set()).add(i)
    left = {i: "\n".join(x for x in t.split("\n") if len(lower(x.strip())) < 10 or i == min(keys[lower(x.strip())]))
            for i, t in left.items()}
    sets = {}
    for i, t in left.items():
        w = re.findall(alnum, lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in left}
    for _ in left:
        for a in left:
            for b in left:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[b] = min(root[a], root[b])
    left = {i: t for i, t in left.items() if root[i] == i}
    grams = {" ".join(w[k:k + 10]) for _, t in items for w in [re.findall(alnum, lower(t))] for k in range(max(1, len(w) - 9)) if w}
    left = {i: t for i, t in left.items() if not any(f" {g} " in f" {' '.join(re.findall(alnum, lower(t)))} " for g in grams)}

    tokenizer = bpe.Encoder(tokenizer_spec()).tok
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}
    got: dict[int, int] = {}
    for r in P.run(spark, str(tmp_path)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want and 2 not in got and 3 not in got and 9 not in got and {1, 4, 5, 8, 12} <= set(got)
