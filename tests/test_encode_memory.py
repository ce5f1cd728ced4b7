"""What the encoder stage holds and how often it runs."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from lexalign.operators import encode as E
from lexalign.operators.distill import label_with_teacher, training_rows


def test_a_batch_of_texts_never_is_python_strings_as_a_whole(spark):
    """The encoder reports the most bytes that Python objects took: the batch as it came (40 MB), and no 2000 strings beside it."""
    def factory():
        import tracemalloc
        tracemalloc.start()

        def run(texts, lang):
            return np.full((len(texts), 1), float(tracemalloc.get_traced_memory()[1]))
        return run

    df = spark.range(2000).coalesce(1).select("id", F.rpad(F.col("id").cast("string"), 20_000, "x").alias("t"))
    most = E.encode(df, "t", factory, 1, batch_size=10, element="double").agg(F.max(F.col("vec")[0])).first()[0]
    assert most < 60e6


def test_counts_of_odd_texts():
    rng = np.random.default_rng(5)
    texts = [None, "", "ab", "ABC", "aaaa", "\U0001f600" * 4 + "\x00", "".join(map(chr, rng.integers(0x20, 0xD000, 9000)))] + ["ab c"] * 3
    for dim, n in ((64, 3), (7, 1), (5, 6)):
        got = E.hashed_ngram_batch(texts, dim, n)
        for t, v in zip(texts, got):
            t = (t or "").lower()
            want = np.zeros(dim)
            for i in range(len(t) - n + 1):
                want[int.from_bytes(hashlib.md5(t[i:i + n].encode()).digest()[:2], "big") % dim] += 1
            assert v is None if len(t) < n else np.array_equal(v, want / np.sqrt(want @ want))


def test_labels_are_worked_out_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<double>")
    def teacher(s):
        calls.add(len(s))
        return s.map(lambda x: [1.0])

    par = spark.createDataFrame([(i, f"e{i}", f"n{i}" if i else None) for i in range(30)], "ord long, english string, non_english string")
    rows = training_rows(label_with_teacher(par, teacher, keys=["ord"]), ["ord"]).collect()
    assert sorted((r.ord, r.text or "") for r in rows) == sorted((i, t) for i in range(30) for t in (f"e{i}", f"n{i}" if i else ""))
    assert calls.value == 30
