"""Sentence encoders and vector-set utilities.

* ``hashed_ngram_vector`` (X4) is a model-free encoder written as one Catalyst
  expression: character n-grams of the whole lower-cased text are hashed into
  ``dim`` buckets by the first 16 bits of their MD5, counted and L2-normalised.  It
  stands in for transformer encoders, which cannot be installed here.
* ``encode`` (X1/X2) runs any user-supplied batch encoder over a DataFrame with
  ``mapInArrow``: the encoder is built once per Python worker and called on parts of Arrow
  batches, never per row; only the texts of one part are Python strings at a time.  A language-code column (X2) is passed through per batch.
* ``mean_pool`` (A1) averages token vectors per sentence with ``Summarizer`` (a partial
  aggregate), dropping the first and last token (special tokens) first; sentences left
  without tokens are dropped (P10) and can be listed with ``empty_sentences``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexalign.functions.vectors import as_double, let, normalize, quantise

DEFAULT_DIM = 64
DEFAULT_N = 3
STUDENT_MAX_TOKENS = 128

def ngram_buckets(t: Column, dim: int = DEFAULT_DIM, n: int = DEFAULT_N) -> Column:
    """Array of bucket ids, one per character n-gram of ``t``."""
    ln = F.length(t)
    idx = F.when(ln >= n, F.sequence(F.lit(1), ln - F.lit(n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.pmod(F.conv(F.substring(F.md5(t.substr(i, F.lit(n))), 1, 4), 16, 10)
                                             .cast("int"), F.lit(dim)))


def _bucket_counts(b: Column, dim: int) -> Column:
    """Dense ``array<double>`` of how often each bucket id occurs in ``b``.

    Run-length counting on the sorted ids: the count of a distinct id is the distance to
    the first position of the next distinct id (``array_position`` is a native scan), so
    the lambdas run once per distinct id, not once per id and bucket."""
    def from_sorted(srt):
        def count_of(d):
            n = F.size(d)
            return F.transform(d, lambda v, i: (F.when(i + 1 < n, F.array_position(srt, F.element_at(d, i + 2)))
                                                .otherwise(F.size(srt) + 1) - F.array_position(srt, v))
                               .cast("double"))
        return let(F.array_distinct(srt), lambda d: let(F.map_from_arrays(d, count_of(d)), lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)), lambda j: F.coalesce(F.element_at(m, j), F.lit(0.0)))))
    return let(F.sort_array(b), from_sorted)  # native sort; array_sort would call a comparator lambda


def hashed_ngram_vector(text: Column, dim: int = DEFAULT_DIM, n: int = DEFAULT_N) -> Column:
    """L2-normalised bucket counts as ``array<double>`` (null for texts shorter than ``n``)."""
    b = let(F.lower(text), lambda t: ngram_buckets(t, dim, n))
    return normalize(_bucket_counts(b, dim))


def truncate_tokens(text: Column, n: int = STUDENT_MAX_TOKENS) -> Column:
    """Keep the first ``n`` whitespace tokens."""
    return F.array_join(F.slice(F.split(F.trim(text), r"\s+"), 1, n), " ")


def encode(df: DataFrame, text_col: str, encoder_factory: Callable, dim: int, out_col: str = "vec",
           lang_col: str | None = None, batch_size: int = 256, element: str = "float") -> DataFrame:
    """Apply a batch encoder.  ``encoder_factory()`` returns ``f(texts, lang) -> 2-D array``.

    Rows keep their other columns; ``element`` is the type of the vector's elements.  The factory runs once per Python worker process.
    """
    schema = df.schema.simpleString()[len("struct<"):-1]
    out_schema = f"{schema}, {out_col} array<{element}>"
    kind = {"float": "float32", "double": "float64"}[element]
    # the factory's content, not its address, names the encoder: addresses are used again
    key = f"enc_{hashlib.sha256(cloudpickle.dumps(encoder_factory)).hexdigest()}_{dim}"

    def run(batches):
        import sys
        import types

        import numpy as np
        import pyarrow as pa

        # one encoder per Python worker process, kept across tasks
        store = sys.modules.setdefault("_lexalign_encoders", types.ModuleType("_lexalign_encoders"))
        if not hasattr(store, key):
            setattr(store, key, encoder_factory())
        enc = getattr(store, key)
        for batch in batches:
            n, texts = batch.num_rows, batch.column(text_col)
            if lang_col is None:
                groups = [(None, np.arange(n))]
            else:  # by place; rows without a code are encoded with None
                codes, names = pd.factorize(batch.column(lang_col).to_pandas())
                groups = [(None if c < 0 else names[c], np.flatnonzero(codes == c)) for c in np.unique(codes)]
            out = np.empty((n, dim), kind)
            for lang, at in groups:
                for s in range(0, len(at), batch_size):
                    part = at[s:s + batch_size]
                    m = np.asarray(enc(texts.take(pa.array(part)).to_pylist(), lang), dtype=kind)
                    if m.ndim != 2 or m.shape[1] != dim:
                        raise ValueError(f"encoder returned shape {m.shape}, expected (*, {dim})")
                    out[part] = m
            vecs = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, vecs], names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, out_schema)


def check_dims(vecs: DataFrame, dims: DataFrame, vec_col: str = "vec", model_col: str = "model", on_bad: str = "flag") -> DataFrame:
    """Flags rows whose vector length differs from the registry dimension of their model, or with ``on_bad='fail'``
    fails on the first such row."""
    if on_bad not in ("flag", "fail"):
        raise ValueError(f"unknown on_bad {on_bad!r}; expected 'flag' or 'fail'")
    out = vecs.join(dims, model_col, "left").withColumn(
        "dim_ok", F.coalesce(F.size(vec_col) == F.col("dim"), F.lit(False)))
    if on_bad == "flag":
        return out
    told = F.concat(F.lit("vector of "), F.coalesce(F.size(vec_col).cast("string"), F.lit("no")), F.lit(" elements, but model "),
                    F.coalesce(F.col(model_col).cast("string"), F.lit("null")), F.lit(" has "), F.coalesce(F.col("dim").cast("string"), F.lit("no dimension")))
    return out.where(F.when(F.col("dim_ok"), F.lit(True)).otherwise(F.raise_error(told)))


def vec_header(vecs: DataFrame, keys, vec_col: str = "vec") -> DataFrame:
    """``(keys, n, dim)`` — the ``.vec`` header line of every vector set."""
    return vecs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec_col)).cast("bigint").alias("dim"))


def quantise_vectors(vecs: DataFrame, vec_col: str = "vec", digits: int = 6) -> DataFrame:
    """Round every element to ``digits`` decimals (the ``.vec`` text precision)."""
    return vecs.withColumn(vec_col, quantise(vec_col, digits))


def _token_bounds(tokens: DataFrame, keys, pos_col):
    return tokens.groupBy(*keys).agg(F.min(pos_col).alias("_first"), F.max(pos_col).alias("_last"),
                                     F.count(F.lit(1)).alias("_n"))


def mean_pool(tokens: DataFrame, keys, pos_col: str = "pos", vec_col: str = "vec",
              drop_special: bool = True) -> DataFrame:
    """A1 (+P10): ``(keys, n_tokens, vec)`` — element-wise mean of the token vectors.

    With ``drop_special`` the first and last token of every sentence are removed first
    (as encoder outputs carry special tokens there).  Sentences without tokens left are
    dropped.  The mean is a ``Summarizer`` aggregate: partial per task, merged after the
    shuffle, so a long sentence is never gathered in one place.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    keys = list(keys)
    t = tokens
    if drop_special:
        t = (t.join(_token_bounds(tokens, keys, pos_col), keys)
             .where((F.col(pos_col) != F.col("_first")) & (F.col(pos_col) != F.col("_last"))))
    return (t.select(*keys, array_to_vector(as_double(vec_col)).alias("_v"))
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_tokens"), Summarizer.mean(F.col("_v")).alias("_m"))
            .select(*keys, "n_tokens", vector_to_array("_m").alias(vec_col)))


def empty_sentences(tokens: DataFrame, keys, pos_col: str = "pos", drop_special: bool = True) -> DataFrame:
    """P10 report: ``(keys, n_tokens, kept)`` for every sentence, ``kept`` false when no token remains."""
    b = _token_bounds(tokens, keys, pos_col)
    n = F.col("_n") - (F.lit(2) if drop_special else F.lit(0))
    n = F.greatest(n, F.lit(0)) if drop_special else n
    return b.select(*keys, n.alias("n_tokens"), (n > 0).alias("kept"))


def long_form(df: DataFrame, keys, vec_col: str = "vec", digits: int | None = 6, nonzero: bool = False) -> DataFrame:
    """``(keys, dim_idx, value)``: one row per vector element (for inspection and checks).

    ``inline`` of (index, value) structs, not ``posexplode``: the filter Spark infers in front
    of ``posexplode`` would evaluate a computed vector a second time."""
    out = df.select(*keys, F.inline(F.transform(vec_col, lambda x, i: F.struct(i.cast("bigint").alias("dim_idx"),
                                                                                x.alias("value")))))
    if nonzero:
        out = out.where(F.col("value") != 0)
    if digits is not None:
        out = out.withColumn("value", F.round("value", digits))
    return out


#: characters whose n-grams are counted at a time, and n-grams whose hashes a worker keeps
CHARS = 1 << 19
KNOWN = 1 << 18
_HASHES: dict[str, int] = {}


def _hashes(grams) -> list[int]:
    """The first two MD5 bytes of every n-gram; a worker keeps what it has hashed."""
    if len(_HASHES) > KNOWN:
        _HASHES.clear()
    for g in grams:
        if g not in _HASHES:
            _HASHES[g] = int.from_bytes(hashlib.md5(g.encode("utf-8")).digest()[:2], "big")
    return [_HASHES[g] for g in grams]


def _ngram_counts(texts, dim: int, n: int):
    """``(texts, dim)`` counts of buckets, for texts of at least ``n`` characters."""
    import numpy as np

    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    m = len(code) - n + 1
    at = np.flatnonzero(row[:m] == row[n - 1:])  # n-grams lie in one text
    seen = np.zeros(int(code.max()) + 1, bool)
    seen[code] = True
    letter, letters = (np.cumsum(seen) - 1)[code], int(seen.sum())
    gram, size = letter[at], letters
    for k in range(1, n):
        if size * letters >= 1 << 62:
            gram = np.unique(gram, return_inverse=True)[1]
            size = int(gram.max()) + 1
        gram, size = gram * letters + letter[at + k], size * letters
    if size <= 8 * CHARS:
        place = np.full(size, -1, np.int32)
        place[gram] = at
        known = np.flatnonzero(place >= 0)
        first, number = place[known], place
        number[known] = np.arange(len(known))
        gram = number[gram]
    else:
        _, first, gram = np.unique(gram, return_index=True, return_inverse=True)
        first = at[first]
    bucket = np.array(_hashes([joined[p:p + n] for p in first.tolist()]), np.int64) % dim
    return np.bincount(row[at] * dim + bucket[gram], minlength=len(texts) * dim).reshape(-1, dim)


def hashed_ngram_batch(texts, dim: int = DEFAULT_DIM, n: int = DEFAULT_N):
    """X4 on a batch of Python strings -> list of unit vectors (None where no n-gram exists).

    Same definition as ``hashed_ngram_vector``: bucket = first two MD5 bytes mod ``dim``.  N-grams of about ``CHARS``
    characters are numbered and counted together."""
    import numpy as np

    out = [None] * len(texts)
    some, size = [], 0
    for i, t in enumerate(texts):
        t = (t or "").lower()
        if len(t) >= n:
            some.append((i, t))
            size += len(t)
        if some and (size >= CHARS or i + 1 == len(texts)):
            counts = _ngram_counts([t for _, t in some], dim, n).astype(float)
            counts /= np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            for (k, _), v in zip(some, counts):
                out[k] = v
            some, size = [], 0
    return out


def hashed_ngram_udf(dim: int = DEFAULT_DIM, n: int = DEFAULT_N):
    """X4 as a vectorised (Arrow-batched) pandas UDF: ``udf(col) -> array<double>``.

    The encoder stage is model inference in the pipeline; this batch form runs it the way a
    real encoder runs (one Python call per Arrow batch), and is several times faster than the
    per-gram Catalyst lambdas of ``hashed_ngram_vector``."""

    @F.pandas_udf("array<double>")
    def enc(s: pd.Series) -> pd.Series:
        return pd.Series(hashed_ngram_batch(s.tolist(), dim, n))

    return enc
