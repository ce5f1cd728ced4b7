"""Word scanning, line dedup, decontamination, license rules and fingerprints against plain Python."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexalign.llm import decontaminate as DC
from lexalign.llm import license_scan as LS
from lexalign.llm import line_dedup as LD
from lexalign.llm import spotsigs as SP
from lexalign.llm import words as W

from hostile import frame, lower, rows

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \n\t.é中-_'", max_size=30)), max_size=6), st.integers(1, 40))
def test_words_are_the_regex_words(texts, size):
    for kind, pattern in ((W.ALNUM, ALNUM), (W.NOT_SPACE, SPACED)):
        seen = {}
        for s in W.slices(pa.array(texts, pa.string()), size):
            w = W.words(s, kind)
            for k in range(len(s)):
                got = [bytes(w.low[w.start[j]:w.end[j]]).decode() for j in range(w.first[k], w.first[k + 1])]
                assert got == re.findall(pattern, lower(texts[s.first + k]))
                for word, h in zip(got, w.hash[w.first[k]:w.first[k + 1]].tolist()):
                    assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_chains_do_not_depend_on_place():
    h = np.array([5, 6, 7, 8, 5, 6, 7, 9], W.U64)
    c = W.chain(h, 3)
    assert c[0] == c[4] and len(set(c.tolist())) == 5 and len(W.chain(h, 9)) == 0


def _ids(data):
    return [(1 << 62 if i is None else i, t or "") for i, t in data]


def test_line_dedup_of_long_and_repeated_rows(spark):
    many = [f"line number {k} of a long text" for k in range(20_000)]
    data = [(1, "\n".join(many)), (2, "\n".join(["own first line", *many, "own last line"])),
            (2, "\n".join(many[5:7] + ["another text of two"])), (2, "\n".join(many[5:7] + ["another text of two"])), (None, many[9] + "\n")]
    got = sorted(((r.doc_id or 0), r.n_lines, r.n_dropped, r.text) for r in LD.dedup_lines(frame(spark, data)).collect())
    assert got == sorted([(1, 20_000, 0, data[0][1]), (2, 20_002, 20_000, "own first line\nown last line"),
                          (2, 3, 2, "another text of two"), (2, 3, 2, "another text of two"), (0, 2, 1, "")])
    assert sorted(r.text for r in LD.clean(frame(spark, data)).collect()) == sorted(x[3] for x in got)


def test_line_dedup(spark):
    def key(x):
        return lower(x.strip(" \t\n\x0b\x0c\r"))

    data = rows()
    holders = defaultdict(set)
    for i, t in _ids(data):
        for x in t.split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(i)
    want = Counter()
    for (i, t), (raw, _) in zip(_ids(data), data):
        kept = [x for x in t.split("\n") if not (len(holders.get(key(x), ())) >= 2 and i != min(holders[key(x)]))]
        want[raw, len(t.split("\n")), len(t.split("\n")) - len(kept), "\n".join(kept)] += 1
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in LD.dedup_lines(frame(spark)).collect())
    assert got == want
    cleaned = LD.clean(frame(spark))
    assert cleaned.columns == frame(spark).columns
    assert Counter(r.text or "" for r in cleaned.collect()) == Counter({k[3]: 0 for k in want}) + Counter(
        x for k, n in want.items() for x in [k[3]] * n)
    assert LD.dedup_lines(frame(spark, [])).count() == 0


def _bench(spark):
    text = dict(rows())
    words = text[11].split()
    items = [("1", " ".join(words[70:95])), ("1", None), (None, "Nobody: said"), ("3", "no such words here"), ("4", ""), ("5", "MIT license")]
    return items, spark.createDataFrame([(i, t, "?") for i, t in items], "item_id string, text string, words string")


def _hits(text, items, n=10):
    w = re.findall(ALNUM, lower(text))
    hit, names = set(), set()
    for item, t in items:
        b = re.findall(ALNUM, lower(t))
        m = min(n, len(b))
        for k in range(len(b) - m + 1) if m else ():
            for i in range(len(w) - m + 1):
                if w[i:i + m] == b[k:k + m]:
                    hit.update(range(i, i + m))
                    names.add(item or "")
    return len(w), len(hit), tuple(sorted(names))


@pytest.mark.parametrize("block", [DC.BLOCK, 7])
def test_decontamination(spark, block):
    items, bench = _bench(spark)
    got = Counter((r.doc_id, r.n_words, sum(r.spans[1::2]) - sum(r.spans[::2]), tuple(r["items"]))
                  for r in DC.scan(frame(spark), bench, block=block).collect())
    assert got == Counter((i, *_hits(t, items)) for i, t in rows())
    kept = DC.keep_clean(frame(spark), bench, block=block)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in rows() if not _hits(t, items)[1])


def test_decontamination_cuts_spans(spark):
    _, bench = _bench(spark)
    got = {r.text for r in DC.decontaminate(frame(spark, [(1, "x Nobody -- Said, y"), (2, None)]), bench, remove="spans").collect()}
    assert got == {"x , y", ""}
    with pytest.raises(ValueError):
        DC.decontaminate(frame(spark), bench, remove="words")
    assert DC.scan(frame(spark), bench.limit(0)).where("size(spans) > 0").count() == 0


def test_license_base_places(spark):
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in LS.scan(frame(spark)).collect())
    want = Counter()
    for i, t in rows():
        w = re.findall(ALNUM, lower(t))
        at = [(k, label) for p, label in LS.BASE.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        want[i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))] += 1
    assert got == want and LS.scan(frame(spark, [])).count() == 0


def test_license_rules_suppress_what_they_contain():
    def found(text):
        return [r.label for _, _, r in LS.detect(re.findall(rb"[0-9a-z\x80-\xff]+", lower(text).encode()))[0]]

    assert len(LS.rules()) > 300
    assert found("Licensed under the Apache License, Version 2.0") == ["apache-2.0"]
    assert found("SPDX-License-Identifier: GPL-2.0-only") == ["gpl-2.0"]
    assert found("CC BY-NC 4.0 or the MIT License") == ["cc-by-nc-4.0", "mit"]
    assert found("a bsd 3-clause license; all rights reserved") == ["bsd-3-clause", "all-rights-reserved"]
    assert found("nothing of that kind") == []


def test_license_suppression_is_its_definition():
    rng = np.random.default_rng(7)
    some = LS.rules()[::20]
    for _ in range(200):
        starts = rng.integers(0, 30, rng.integers(0, 25))
        hits = [(int(a), int(a + rng.integers(1, 9)), some[rng.integers(len(some))]) for a in starts]
        want = []
        for a, z, r in sorted(hits, key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].name)):
            if not any(x <= a and z <= y for x, y, _ in want):
                want.append((a, z, r))
        assert LS.outermost(hits) == sorted(want, key=lambda h: (h[0], h[1], h[2].name))


def test_license_detections_of_a_long_text():
    one = b"licensed under the apache license version 2 0 or the mit license".split()
    found, places = LS.detect(one * 4000)
    assert Counter(r.label for _, _, r in found) == {"apache-2.0": 4000, "mit": 4000}
    assert len(places) == 8000 and places[-1] == (len(one) * 4000 - 2, "mit")
    assert [(a, z) for a, z, _ in found[:2]] == [(a, z) for a, z, _ in LS.detect(one)[0]]


def _written_out(parsed):
    """Texts of a parsed pattern: every alternative, optional parts with and without, classes by their first member."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            more = [chr(arg)]
        elif op == "IN":
            more = [chr(arg[0][1] if isinstance(arg[0][1], int) else arg[0][1][0])]
        elif op == "SUBPATTERN":
            more = _written_out(arg[3])
        elif op == "BRANCH":
            more = [x for a in arg[1] for x in _written_out(a)]
        else:
            assert op == "MAX_REPEAT", op
            more = ([""] if arg[0] == 0 else []) + _written_out(arg[2])
        out = [x + y for x in out for y in more]
    return out


def test_license_names_pass_their_keywords_and_the_gate():
    for label, name, keyword, _, _ in LS.FAMILIES:
        for text in _written_out(re._parser.parse(name)):
            assert any(k in text for k in keyword.split()), (label, text)
            assert LS.regions(text.encode().split()), (label, text)
    words = b"licensed under the open data commons attribution license".split()
    assert [r.name for _, _, r in LS.detect(words)[0]] == ["under:odc-by"]


def test_spotsigs_next_document(spark):
    data = [(i, t) for i, t in rows() if i is not None and i != 5] + [(5, rows()[4][1])]
    order = sorted(data, key=lambda x: -x[0])
    want = {}
    for k, (i, t) in enumerate(order):
        t, other = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want[i] = (len(t), hashlib.sha256((t[:len(t) - half] + other[:half]).encode()).hexdigest())
    got = {r.doc_id: r for r in SP.compare_next(frame(spark, data)).collect()}
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == want
    assert got[3].fingerprint == got[4].fingerprint and got[4].near_next == 1.0 and got[3].near_next < 0.1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert SP.compare_next(frame(spark)).count() == len(rows()) and SP.compare_next(frame(spark, [])).count() == 0


def test_spotsigs_likeness_is_that_of_whole_signatures(spark):
    a, b = (" ".join(f"the {x}{k} {x}{k}z" for k in range(6000)) for x in "pq")
    whole = [set(s.tolist()) for s in SP.text_signatures([a.encode(), b.encode()])]
    got = {r.doc_id: r for r in SP.compare_next(frame(spark, [(2, a), (1, b)])).collect()}
    assert got[2].near_next == len(whole[0] & whole[1]) / len(whole[0] | whole[1])
    assert got[2].set_length == len(whole[0])
    written = {i: set(np.frombuffer(base64.b64decode(r.fingerprint), ">u4").tolist()) for i, r in got.items()}
    assert written == {2: whole[0], 1: whole[1]}
    changed = set(np.frombuffer(base64.b64decode(got[2].edited_fingerprint), ">u4").tolist())
    assert got[2].near_edited == len(whole[0] & changed) / len(whole[0] | changed) > 0.3


def test_spotsigs_join_is_the_brute_force_join(spark):
    words = [f"w{k}x{k * k}" for k in range(80)]
    data = rows() + [(50 + e, " ".join(f"the {w if k % 40 >= e else 'edit'}" for k, w in enumerate(words))) for e in range(9)]
    pairs, member = SP.similar(frame(spark, data), 0.8)
    who = {r.fp for r in member.collect()}
    got = {frozenset((r.a, r.b)) for r in pairs.collect()}
    sets = {r.fp: set(r.sigs) for r in SP.fingerprints(frame(spark, data)).withColumn(
        "fp", SP.F.sha2(SP.F.concat_ws(",", "sigs"), 256)).collect()}
    want = {frozenset((a, b)) for a in sets for b in sets if a < b and sets[a] and sets[b]
            and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert got == want and want and who == set(sets)
