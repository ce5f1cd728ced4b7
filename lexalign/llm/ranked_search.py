"""Ranked lexical search over a length-stratified index.

A document's normaliser ``m = 50 + (50 * n * N) div L`` depends on its length alone, so documents of equal ``m`` (a
stratum) score equal for equal term counts: in a stratum an impact is computed once per distinct ``tf``.

Index (``build``): documents are dealt to tasks by length (quantiles of a histogram, so that tasks get equal numbers of
terms; a length that is commoner than a task's share is spread by a hash) and sorted by ``m``.  A task inverts runs of at most ``BLOCK_DOCS`` documents or about
``BLOCK_BYTES`` of text, and each becomes one row:

* ``docs``, ``m``: ids and normalisers, in order of ``m``, so that a stratum is a run of places;
* ``terms``, ``starts``: the block's terms (one text, a line each) and where the postings of each begin;
* ``post``, ``tf``: place and count of every posting, by term, then stratum, then ``tf`` from the largest.

Whole numbers of a block are kept as little-endian bytes (``post`` 16 bits, else 32), which Spark passes on as they are.

Search (``search``): items are taken in blocks of at most ``ITEMS`` (their terms go to the tasks with the function, the
only thing that travels to all of them).  The index is scanned three times, and never moves:

1. document frequencies of the item terms;
2. a bound for every item and stratum: the sum of ``w`` times the impact of the stratum's largest ``tf``.  In each block
   the best strata of an item are visited until they hold ``k`` documents of it; the ``k``-th best score of all tasks is
   the item's threshold;
3. every other stratum whose bound reaches the threshold is visited.

A task's own ``k``-th best score is a threshold too, from block to block.  It hands out at most ``k`` documents per item,
and a window with a group limit takes the ``k`` best of all.
Scores are whole numbers below 2**53, so sums of doubles are exact.

Cases: null and empty texts have no terms and no rank.  A null ``doc_id`` takes part and comes last among ties.  Rows
that repeat a ``doc_id`` are documents of their own.  Rows that repeat an ``item_id`` (null included) are one item with
the terms of all.  Other columns are ignored.  Empty tables give an empty result.  Terms are told apart by 64-bit hashes
while a block is inverted and by their characters after that.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .tables import Scratch, documents, null_last, partitions

K = 50
BLOCK_DOCS, BLOCK_BYTES = 2048, 1 << 20
#: items, and terms of items, that one scan takes
ITEMS, ITEM_TERMS = 512, 1 << 17
#: contributions added up at a time
STEP = 1 << 19
NULL_ID = np.iinfo(np.int64).max

#: the words of ``words.ALNUM`` for a Java regular expression, after A-Z became a-z
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SCHEMA = "docs array<long>, m array<long>, terms string, starts binary, post binary, tf binary"
_LINE = 10


@dataclass
class Index:
    """The index table, and the counts over all documents that scores need."""

    table: DataFrame
    n_docs: int
    n_terms: int


def _count(texts: pa.Array) -> pa.Array:
    """Terms per text, with repeats."""
    out = [np.diff(W.words(s, W.ALNUM).first) for s in W.slices(texts)]
    return pa.array(np.concatenate(out) if out else np.empty(0, np.int64), pa.int64())


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``start[i] .. start[i] + size[i]`` of all i in one array, and the i of each."""
    owner = np.repeat(np.arange(len(size)), size)
    first = np.cumsum(size) - size
    return start[owner] + np.arange(len(owner)) - first[owner], owner


def _invert(ids: np.ndarray, m: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
    """One index row of documents that are sorted by ``m``."""
    s = next(W.slices(texts, 1 << 62))
    w = W.words(s, W.ALNUM)
    doc = w.doc()
    order = np.argsort(w.hash, kind="stable")  # words come by document, so documents stay in order
    h, doc = w.hash[order], doc[order]
    at = _runs(h, doc)
    tf = np.diff(np.append(at, len(h)))
    h, place, sample = h[at], doc[at], order[at]
    stratum = np.cumsum(np.append(0, np.diff(m) != 0))[place]
    first = _runs(h)
    term = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
    by = np.lexsort((-tf, term * (int(stratum.max(initial=0)) + 1) + stratum))
    sample = sample[first]
    size = w.end[sample] - w.start[sample] + 1
    spell, _ = _spread(w.start[sample], size)
    spell[np.cumsum(size) - 1] = len(w.low)
    terms = np.append(w.low, np.uint8(_LINE))[spell].tobytes()
    starts = np.append(first, len(h))
    known = pa.array(ids, pa.int64(), mask=ids == NULL_ID)
    row = [pa.array([c.tolist()], pa.list_(pa.int64())) for c in (known, pa.array(m, pa.int64()))]
    row += [pa.array([terms], pa.binary()).cast(pa.string()), *[pa.array([c.astype(t).tobytes()], pa.binary()) for c, t in (
        (starts, "<i4"), (place[by], "<u2"), (tf[by], "<i4"))]]
    return pa.RecordBatch.from_arrays(row, names=["docs", "m", "terms", "starts", "post", "tf"])


def _inverted(batches):
    """Index rows of a partition's ``(id, m, text)`` rows, which come sorted by ``m``."""
    held, docs, size = [], 0, 0

    def flush():
        ids, m, texts = (pa.concat_arrays([b.column(c) for b in held]) for c in range(3))
        return _invert(ids.to_numpy(), m.to_numpy(), texts)

    for b in batches:
        sizes = pc.binary_length(b.column(2)).to_numpy()
        start = 0
        for i in range(b.num_rows):
            if docs and (docs >= BLOCK_DOCS or size + sizes[i] > BLOCK_BYTES):
                if i > start:
                    held.append(b.slice(start, i - start))
                yield flush()
                held, docs, size, start = [], 0, 0, i
            docs, size = docs + 1, size + int(sizes[i])
        if b.num_rows > start:
            held.append(b.slice(start))
    if docs:
        yield flush()


#: what a document costs besides its terms
EACH = 50


def _rounded(n: str):
    """A length to three digits: at most 900 values for each further digit."""
    return F.expr(f"{n} - {n} % bigint(pow(10, greatest(length(string({n})) - 3, 0)))")


def _dealt_by_length(d: DataFrame, cuts: list[float], n: int) -> DataFrame:
    """Partition i holds rounded lengths from ``cuts[i - 1]`` on; one that fills several partitions is spread over them."""
    at = F.array(*[F.lit(int(c)) for c in cuts]).cast("array<long>")
    low, high = (F.size(F.filter(at, lambda c: c < F.col("r"))), F.size(F.filter(at, lambda c: c <= F.col("r"))))
    part = low + F.pmod(F.xxhash64("doc_id", F.length("text")), (high - low + 1).cast("long"))
    return d.withColumn("r", _rounded("n")).repartitionById(n, part.cast("int"))


def build(docs: DataFrame, path: Scratch) -> Index:
    """Write the index of ``docs(doc_id, text)``: every document with at least one term is in it once."""
    spark = docs.sparkSession
    count = F.arrow_udf(_count, "long").asNondeterministic()  # or the filter below would count a second time
    d = documents(docs).withColumn("n", count(F.col("text")))
    n = partitions(spark)
    share = [i / n for i in range(1, n)] or [0.5]
    lengths = d.select("n").where("n > 0").groupBy(_rounded("n").alias("r")).agg(F.count("n").alias("docs"), F.sum("n").alias("terms"))
    row = lengths.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"),
                      F.percentile("r", share, F.col("terms") + EACH * F.col("docs")).alias("cuts")).first()
    total, length = int(row["docs"] or 0), int(row["terms"] or 0)
    m = F.lit(50) + F.expr(f"(50L * n * {total}L) div {max(length, 1)}L")
    ready = (_dealt_by_length(d.where("n > 0"), (row["cuts"] or [])[: n - 1], n)
             .select(null_last("doc_id").alias("id"), m.alias("m"), "text").sortWithinPartitions("m", "id"))
    return Index(path.save(ready.mapInArrow(_inverted, _SCHEMA), "index"), total, length)


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, terms)``: the distinct terms of every item."""
    text = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    t = items.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0))).alias("term"))
    return t.groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def _item_blocks(items: DataFrame) -> DataFrame:
    """``item_terms`` in order of blocks that hold at most about ``ITEMS`` items and ``ITEM_TERMS`` terms."""
    t = item_terms(items)
    size = t.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("terms")).alias("t")).first()
    blocks = max(1, -(-2 * size["n"] // ITEMS), -(-2 * (size["t"] or 0) // ITEM_TERMS)) if size["n"] > ITEMS or (size["t"] or 0) > ITEM_TERMS else 1
    return t.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")), blocks


class _Block:
    """One row of the index, cut down to the terms of the items."""

    def __init__(self, batch: pa.RecordBatch, i: int, vocab: pa.Array, full: bool = True):
        def numbers(name, kind):
            return np.frombuffer(batch.column(name)[i].as_buffer(), kind).astype(np.int64)

        line = np.frombuffer(batch.column("terms")[i].as_buffer(), np.uint8)
        ends = np.flatnonzero(line == _LINE)
        spelled = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(np.append(0, ends + 1).astype(np.int32)), pa.py_buffer(line)])
        found = pc.index_in(spelled, value_set=vocab)
        has = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        self.term = found.take(pa.array(has)).to_numpy()  # number in vocab
        starts = numbers("starts", "<i4")
        self.start, self.df = starts[has], starts[has + 1] - starts[has]
        if not full:
            return
        self.docs = batch.column("docs")[i].values.fill_null(NULL_ID).to_numpy()
        m = batch.column("m")[i].values.to_numpy()
        self.stratum = np.cumsum(np.append(0, np.diff(m) != 0))
        at, owner = _spread(self.start, self.df)
        self.post, tf = numbers("post", "<u2")[at], numbers("tf", "<i4")[at]
        # one impact for each tf of a stratum
        both, back = np.unique(m[self.post] * (int(tf.max(initial=0)) + 1) + tf, return_inverse=True)
        um, ut = both // (int(tf.max(initial=0)) + 1), both % (int(tf.max(initial=0)) + 1)
        self.impact = ((1_000_000_000 * ut) // (1000 * ut + 20 * um))[back].astype(float)
        s = self.stratum[self.post]
        self.run = _runs(owner, s)  # a term's postings in a stratum, the largest tf first
        self.run_size = np.diff(np.append(self.run, len(s)))
        self.run_stratum, self.run_best = s[self.run], self.impact[self.run]
        self.term_run = np.searchsorted(self.run, np.append(0, np.cumsum(self.df)))


def _visit(b: _Block, who: np.ndarray, term: np.ndarray, weight: np.ndarray, n_items: int, least: np.ndarray, k: int, late: bool):
    """Scores of at least ``least[item]`` of the documents that an item's visits reach, as ``(item, place, score)``.

    ``who, term, weight`` list the terms of the items.  Early visits go to the best strata of an item, until these hold
    ``k`` of its documents, late ones to all others.  Strata whose bound is below ``least[item]`` are left out."""
    here = np.full(int(max(term.max(initial=-1), b.term.max(initial=-1))) + 1, -1)
    here[b.term] = np.arange(len(b.term))
    have = here[term] >= 0
    who, slot, weight = who[have], here[term[have]], weight[have]
    run, pair = _spread(b.term_run[slot], b.term_run[slot + 1] - b.term_run[slot])
    item, w = who[pair], weight[pair]
    strata = int(b.stratum[-1]) + 1
    cell = item * strata + b.run_stratum[run]
    bound = np.bincount(cell, w * b.run_best[run], n_items * strata)
    # a stratum holds at least as many documents of an item as its commonest term of the item
    least_docs = np.zeros(n_items * strata, np.int64)
    np.maximum.at(least_docs, cell[w > 0], b.run_size[run[w > 0]])
    cells = np.flatnonzero(bound > 0)
    order = cells[np.lexsort((-bound[cells], cells // strata))]
    sizes = np.cumsum(least_docs[order]) - least_docs[order]
    first = _runs(order // strata)
    before = sizes - np.repeat(sizes[first], np.diff(np.append(first, len(order))))
    early = np.zeros(n_items * strata, bool)
    early[order[before < k]] = True
    chosen = (early != late) & (bound > 0) & (bound >= np.repeat(least, strata))
    go = chosen[cell]
    run, item, w = run[go], item[go], w[go]
    score = np.zeros(n_items * len(b.docs))
    edge = np.searchsorted(np.cumsum(b.run_size[run]), np.arange(0, int(b.run_size[run].sum()), STEP), "right")
    for a, z in zip(edge, np.append(edge[1:], len(run))):
        at, owner = _spread(b.run[run[a:z]], b.run_size[run[a:z]])
        key = item[a:z][owner] * len(b.docs) + b.post[at]
        score += np.bincount(key, w[a:z][owner] * b.impact[at], len(score)) if len(key) else 0
    hit = np.flatnonzero(score > 0)
    hit = hit[score[hit] >= least[hit // len(b.docs)]]
    return hit // len(b.docs), hit % len(b.docs), score[hit]


def _lines(vocab: list[str]) -> pa.Array:
    """The terms as blocks spell them, each with its line end."""
    return pa.array([t + "\n" for t in vocab], pa.string())


def _scan(vocab: list[str], who, term, weight, n_items: int, least, k: int):
    """``mapInArrow`` function: the ``k`` best documents of a task for each item, as ``(item, doc, score)``.

    A task keeps its best so far, and what they must reach, from block to block."""

    def run(batches):
        words = _lines(vocab)
        late = least is not None
        floor = least.copy() if late else np.ones(n_items)
        item, docs, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for batch in batches:
            for i in range(batch.num_rows):
                b = _Block(batch, i, words)
                if not len(b.post):
                    continue
                more, place, new = _visit(b, who, term, weight, n_items, floor, k, late)
                item, docs, score = np.append(item, more), np.append(docs, b.docs[place]), np.append(score, new)
                order = np.lexsort((docs, -score, item))
                item, docs, score = item[order], docs[order], score[order]
                first = _runs(item)
                rank = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
                last = rank == k - 1
                floor[item[last]] = np.maximum(floor[item[last]], score[last])
                top = rank < k
                item, docs, score = item[top], docs[top], score[top]
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(docs, pa.int64()), pa.array(score.astype(np.int64))],
                                             names=["item", "doc", "score"])

    return run


def _frequencies(index: Index, vocab: list[str]) -> np.ndarray:
    """Documents that hold each term, over the whole index."""

    def run(batches):
        words = _lines(vocab)
        for batch in batches:
            total = np.zeros(len(vocab), np.int64)
            for i in range(batch.num_rows):
                b = _Block(batch, i, words, full=False)
                total[b.term] += b.df
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["term", "df"])

    found = index.table.select("terms", "starts").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(len(vocab), np.int64)
    for r in found.collect():  # one row for each term of a block of items
        out[r["term"]] = r["df"]
    return out


def _top(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    import math

    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], float)


def search(index: Index, items: DataFrame, path: Scratch, k: int = K) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item, best first."""
    spark = items.sparkSession
    asked, blocks = _item_blocks(items)
    kind = asked.schema["item_id"].dataType.simpleString()
    out = None
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).select("item_id", "terms").collect()  # at most about ITEMS
        if not rows:
            continue
        vocab = sorted({t for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocab)}
        who = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
        term = np.array([number[t] for r in rows for t in r["terms"]], np.int64)
        weight = _weights(index.n_docs, _frequencies(index, vocab))[term]
        schema = "item int, doc long, score long"
        ask = (vocab, who, term, weight, len(rows))
        early = path.save(index.table.mapInArrow(_scan(*ask, None, k), schema), f"early-{block}")
        least = np.ones(len(rows))
        for r in _top(early, k).where(F.col("rank") == k).select("item", "score").collect():  # one row an item
            least[r["item"]] = r["score"]
        late = index.table.mapInArrow(_scan(*ask, least, k), schema)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {kind}")
        best = (_top(early.unionByName(late), k).join(names, "item")
                .select("item_id", "rank", F.nullif("doc", F.lit(int(NULL_ID))).alias("doc_id"), "score"))
        out = best if out is None else out.unionByName(best)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """Index ``docs`` and rank them for every item."""
    path = Scratch(docs.sparkSession, "search")
    return search(build(docs, path), items, path, k)
