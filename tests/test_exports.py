"""Resumed encoding, diverted rows and one-file vector exports."""

import os

import numpy as np
import pytest


from lexalign.sources import sinks, text
from lexalign.sources.quarantine import divert
from lexalign.sources.vec_file import write_vec_files
from lexalign.streaming.resume import encode_ranges, encoded


def test_a_stopped_encoding_goes_on(spark, tmpdir_path):
    log = f"{tmpdir_path}/log"  # a worker keeps its encoder, so calls are counted in a file

    def factory(poison=None):
        def encode(texts, lang):
            if poison is not None and poison in texts:
                raise RuntimeError("stopped")
            with open(log, "a") as f:
                f.write("." * len(texts))
            return np.array([[len(t), 1] for t in texts], float)
        return encode

    def calls():
        return os.path.getsize(log)

    df = spark.createDataFrame([("s" if i % 2 else "t", i, "x" * (i % 13)) for i in range(200)] + [("s", None, "no number")],
                               "side string, ord long, text string").repartition(3)
    ask = dict(order_col="ord", text_col="text", dim=2, set_cols=["side"], flush=16, ranges=4)
    half = encode_ranges(df, f"{tmpdir_path}/e", encoder_factory=factory, stop_after=3, **ask)
    some = encoded(half).count()
    assert 0 < some < 201 and calls() == some
    with pytest.raises(Exception, match="stopped"):  # a wave that breaks commits nothing
        encode_ranges(df, f"{tmpdir_path}/e", encoder_factory=lambda: factory("x" * 12), **ask)
    kept, before = encoded(half).count(), calls()
    done = encoded(encode_ranges(df, f"{tmpdir_path}/e", encoder_factory=factory, **ask))
    assert calls() - before == 201 - kept  # no sentence of a committed range is encoded again
    whole = encoded(encode_ranges(df, f"{tmpdir_path}/one", encoder_factory=factory, **ask))
    rows = lambda d: sorted((repr((r.side, r.ord, r.text, list(r.vec))) for r in d.collect()))
    assert rows(done) == rows(whole) and done.count() == 201
    before = calls()
    encode_ranges(df, f"{tmpdir_path}/e", encoder_factory=factory, **ask)
    assert calls() == before
    assert encoded(encode_ranges(df.limit(0), f"{tmpdir_path}/none", encoder_factory=factory, **ask)) is None


def test_divert_scans_once(spark, tmpdir_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("/c/a-b.train.a", i, v) for i, v in enumerate(["1\tone", "2", "3\tthree\tmore", "", "5\tfive"])] + [("/c/a-b.train.a", 9, None)]
    lines = spark.createDataFrame(rows, "file string, line_no int, value string").mapInArrow(count, "file string, line_no int, value string")
    d = divert(text.parse_sentences(lines, on_bad="quarantine"), f"{tmpdir_path}/q")
    assert (d.n_good, d.n_bad, seen.value) == (2, 4, 6)
    assert sorted((r.sent_id, r.text) for r in d.good.collect()) == [("1", "one"), ("5", "five")]
    assert sorted(r.line_no for r in d.bad.collect()) == [1, 2, 3, 9] and "bad" not in d.bad.columns
    with pytest.raises(ValueError, match="4 of 6 rows are bad"):
        divert(text.parse_sentences(lines, on_bad="quarantine"), f"{tmpdir_path}/r", most_bad=0.5)
    none = divert(text.parse_sentences(lines.where("line_no > 99"), on_bad="quarantine"), f"{tmpdir_path}/n", most_bad=0.0)
    assert (none.n_good, none.n_bad, none.good.count(), none.bad.count()) == (0, 0, 0, 0)


@pytest.mark.parametrize("part_bytes", [50, 1 << 20])
def test_one_file_per_set(spark, tmpdir_path, part_bytes):
    rows = [(p, s, i, f"é{i}", [i / 7, -1.0, float(i)]) for p in ("a-b", "c-d") for s in ("test", None) for i in range(40)]
    rows += [("a-b", "test", None, "last", [0.5, 0.5, 0.5]), ("a-b", "test", 3, "tied", [0.0, 0.0, 0.0])]
    vecs = spark.createDataFrame(rows, "pair string, split string, ord long, sent_id string, vec array<double>").repartition(4)
    root = f"{tmpdir_path}/out"
    write_vec_files(vecs, f"file:{root}", ["pair", "split"], "ord", part_bytes=part_bytes)
    assert sorted(os.listdir(root)) == ["a-b.null.vec", "a-b.test.vec", "c-d.null.vec", "c-d.test.vec"]
    want = {}
    for r in sinks.vec_lines(vecs, ["pair", "split"], "ord").collect():
        want.setdefault(f"{r.pair}.{r.split or 'null'}.vec", []).append((r._o is None, r._o or 0 if r._o is not None else 0, r.value))
    for name, lines in want.items():
        got = open(f"{root}/{name}", encoding="utf-8").read()
        assert got.endswith("\n")
        got = got.splitlines()
        assert sorted(got) == sorted(v for _, _, v in lines)
        order = {v: (null, o) for null, o, v in lines}
        assert [order[v] for v in got] == sorted(order[v] for v in got)
    with pytest.raises(FileExistsError):
        write_vec_files(vecs, root, ["pair", "split"], "ord")
    with pytest.raises(ValueError, match="mounted"):
        write_vec_files(vecs, "s3://b/out", ["pair", "split"], "ord")
    assert [f for f in os.listdir(tmpdir_path) if f != "out"] == []


def test_vec_file_reads_back(spark, tmpdir_path):
    vecs = spark.createDataFrame([("hsb-de", "test", "hsb", "m", i, [i * 0.5, 1.0]) for i in range(5)],
                                 "lang_pair string, split string, lang string, model string, sent_id long, vec array<double>")
    write_vec_files(vecs, f"{tmpdir_path}/v", ["lang_pair", "split", "lang", "model"], "sent_id")
    back = text.read_vec(spark, f"{tmpdir_path}/v").orderBy("line_no").collect()
    assert [(r.lang_pair, r.split, r.lang, r.model, r.sent_id, list(r.vec)) for r in back] == [
        ("hsb-de", "test", "hsb", "m", str(i), [i * 0.5, 1.0]) for i in range(5)]
    assert text.vec_header_check(spark, f"{tmpdir_path}/v").first().n_matches
