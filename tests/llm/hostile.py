"""A small table with nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""

import random

SF_SMALL = "/root/testdata/sf0.001"

EXTRA = ["id", "h", "n", "key", "drop", "kept", "spans", "items", "digest", "node", "tk", "bucket", "guest", "score", "n_chars"]


def prose(seed, n):
    r = random.Random(seed)
    words = ["the", "of", "and", "a"] + ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(400)]
    return " ".join(r.choice(words) for _ in range(n))


def rows():
    base = prose(1, 220)
    near = base.replace(base.split()[50], "changed", 1)
    shared = prose(7, 90)
    line = "This Line is shared by several documents"
    return [
        (1, ""), (2, None), (3, base), (4, base), (5, near), (5, near), (None, base), (None, "only here, null id"),
        (6, "x" * 1200), (7, "ab" * 700), (8, "two words"), (9, f"  {line}\t\nshort\n\n{line.upper()}\nlast"),
        (10, f"{line}\nown line of document ten\n"), (11, prose(2, 60) + " " + shared + " " + prose(3, 50)),
        (12, prose(4, 30) + " " + shared + " " + prose(5, 80)), (13, "Été Ñandú straße 中文 don't <|endoftext|>\r\nﬁn x"),
        (14, "Licensed under the Apache License, Version 2.0. CC-BY; mit\nlicense, MIT license"), (15, " \t\n"),
        (16, prose(9, 3000)), (17, "\n"), (-3, "you are an idiot, said nobody"), (18, "the " * 40),
    ]


def frame(spark, data=None):
    data = rows() if data is None else data
    names = ", ".join(f"`{c}` string" for c in EXTRA if c != "n_chars")
    schema = f"doc_id long, text string, {names}, n_chars long"
    return spark.createDataFrame([(i, t, *["?"] * (len(EXTRA) - 1), len(t or "")) for i, t in data], schema).repartition(3)


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})
