"""Exact removal of repeated passages by a logarithmic family of sparse suffix arrays.

A passage of ``size`` bytes is found by one of its own suffixes: among the ``size - HEAD + 1`` heads (``HEAD`` bytes)
that a passage holds, the one with the smallest hash is its anchor, and the same passage has the same anchor wherever
it stands.  Only anchors (about one position in 180) become suffixes of the arrays, so an array is a small, sorted
table of (head, surrounding context, text, position), yet no repeated passage is missed.

New batches get a sorted array each, are merge-scanned against the levels that exist (and inside themselves) for
heads that meet again, and equal levels merge into the next one.  Suffixes that met are compared on the bytes that any
passage with that anchor can span; a window of ``size`` bytes that two of them share is repeated, and only such
windows are removed, so the result is exact (up to 64-bit hashes of equal length strings).

Every text counts once in the arrays; a text that several rows hold is repeated as a whole.

Defined cases: a null text is empty; texts under ``size`` bytes lose nothing; rows with equal texts, whatever their
ids, are copies of each other; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import Scratch, documents, map_texts, maybe_in, partitions, salted_join

SIZE = 400
HEAD = 50
BATCHES = 4
#: rows of a head that one task compares; larger heads are dealt into parts of about as many, whose keys meet by a shuffle
TOGETHER = 4000
#: window starts of a block, for larger heads
BLOCK = 24
_SUFFIX = "head long, ctx long, tk long, n int, pos int"


def _text_key() -> tuple[Column, Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(text).alias("tk"), F.octet_length(text).alias("n")


def anchors(data: np.ndarray, bounds: np.ndarray, size: int, prefix: np.ndarray) -> np.ndarray:
    """Positions of the heads that are the (leftmost) smallest of some window of ``size`` bytes inside one text."""
    n, w = len(data), size - HEAD + 1
    if n < size:
        return np.empty(0, np.int64)
    at = np.arange(n - HEAD + 1)
    bits = W.U64(max(20, int(n).bit_length()))
    key = (W.span_hash(prefix, at, at + HEAD) >> bits << bits) | at.astype(W.U64)
    m = len(key) - w + 1
    full = np.full(-(-len(key) // w) * w, ~W.U64(0), W.U64)
    full[: len(key)] = key
    blocks = full.reshape(-1, w)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(down[:m], up[w - 1 : w - 1 + m])
    inside = np.zeros(m + 1, np.int32)
    long = np.flatnonzero(np.diff(bounds) >= size)
    np.add.at(inside, bounds[long], 1)
    np.add.at(inside, np.minimum(bounds[long + 1] - size + 1, m), -1)
    low = low[np.cumsum(inside[:m]) > 0]
    if not len(low):
        return np.empty(0, np.int64)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] != low[:-1]
    return np.unique((low[new] & ((W.U64(1) << bits) - W.U64(1))).astype(np.int64))


def suffixes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per anchor of every distinct text: hashes of head and context, text key, byte length, position."""

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tk, n = b.column("tk").to_numpy(), b.column("n").to_numpy()
        for s in W.slices(b.column("text"), W.SLICE // 2):
            if len(s.data) < size:
                continue
            prefix = W.prefix_hash(s.data)
            at = anchors(s.data, s.bounds, size, prefix)
            doc = np.searchsorted(s.bounds, at, "right") - 1
            a = np.maximum(at - (size - HEAD), s.bounds[doc])
            z = np.minimum(at + size, s.bounds[doc + 1])
            ctx = W.mix(W.span_hash(prefix, a, z) + (at - a).astype(W.U64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(W.span_hash(prefix, at, at + HEAD))), pa.array(W.signed(ctx)),
                 pa.array(tk[s.first + doc]), pa.array(n[s.first + doc]),
                 pa.array((at - s.bounds[doc]).astype(np.int32))], ["head", "ctx", "tk", "n", "pos"])

    return map_texts(documents(docs).select("text", *_text_key()), work, _SUFFIX).distinct()


class IndexFamily:
    """Levels of sorted suffix tables in the shared folder; level r holds about 2**r batches."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.levels: dict[int, str] = {}
        self.hits: list[str] = []
        self.count = 0

    def _sorted(self, rows: DataFrame, name: str) -> DataFrame:
        n = max(1, partitions(self.scratch.spark))
        order = ["head", "ctx", "tk", "pos"]  # ranges, so that a frequent head is cut over several files
        return self.scratch.save(rows.repartitionByRange(n, *order).sortWithinPartitions(*order), name)

    def insert(self, batch: DataFrame) -> None:
        """Builds the batch's array, scans it against itself and every level, then merges equal levels.

        Heads are counted before they are joined, so a head of a third of all suffixes moves as one row a task.
        """
        self.count += 1
        k, name = self.count, f"batch{self.count}"
        new = self._sorted(batch, name)
        heads = new.groupBy("head").agg(F.count(F.lit(1)).alias("c"))
        met = heads.where("c > 1").select("head")
        for old in self.levels.values():
            met = met.unionByName(heads.select("head").join(
                self.scratch.load(old).groupBy("head").agg(F.count(F.lit(1)).alias("o")), "head").select("head"))
        self.scratch.save(met.distinct(), f"met{k}")
        self.hits.append(f"met{k}")
        rank = 0
        while rank in self.levels:
            old = self.levels.pop(rank)
            merged = self._sorted(self.scratch.load(old).unionByName(self.scratch.load(name)), f"level{rank + 1}_{k}")
            del merged
            self.scratch.drop(old, name)
            name, rank = f"level{rank + 1}_{k}", rank + 1
        self.levels[rank] = name

    def met(self) -> DataFrame:
        """All suffixes whose head occurs at least twice."""
        every, heads = None, None
        for t in self.levels.values():
            x = self.scratch.load(t)
            every = x if every is None else every.unionByName(x)
        for t in self.hits:
            x = self.scratch.load(t)
            heads = x if heads is None else heads.unionByName(x)
        return salted_join(every, heads.distinct(), ["head"], "pos", how="inner")


def _few(b: pa.RecordBatch, rows: int = 200) -> Iterator[pa.RecordBatch]:
    """Small pieces of a batch, so that what a piece becomes as Python objects stays small."""
    for k in range(0, b.num_rows, rows):
        yield b.slice(k, rows)


def _contexts(b: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Cuts the context of every wanted suffix out of its text."""
    out: dict[str, list] = {c: [] for c in ("head", "c", "deals", "tk", "n", "start", "left", "bytes")}
    cols = [b.column(c).to_pylist() for c in ("tk", "n", "want", "text")]
    for tk, n, want, text in zip(*cols, strict=True):
        raw = (text or "").encode()
        for x in want:
            a = max(0, x["pos"] - (size - HEAD))
            out["head"].append(x["head"])
            out["c"].append(x["c"])
            out["deals"].append(x["deals"])
            out["tk"].append(tk)
            out["n"].append(n)
            out["start"].append(a)
            out["left"].append(x["pos"] - a)
            out["bytes"].append(raw[a : x["pos"] + size])
    yield pa.RecordBatch.from_arrays(
        [pa.array(out["head"], pa.int64()), pa.array(out["c"], pa.int64()), pa.array(out["deals"], pa.int32()),
         pa.array(out["tk"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["start"], pa.int32()),
         pa.array(out["left"], pa.int32()), pa.array(out["bytes"], pa.binary())], list(out))


_CONTEXT = "head long, c long, deals int, tk long, n int, start int, left int, bytes binary"
_SPAN = "tk long, n int, start int, end int"


class _Windows:
    """All windows of ``size`` bytes that hold the head of their context, as keys that hold head and offset too."""

    def __init__(self, b: pa.RecordBatch, size: int):
        self.head = b.column("head").to_numpy()
        self.left = b.column("left").to_numpy().astype(np.int64)
        s = next(W.slices(b.column("bytes"), 1 << 62))
        self.begin, stop = s.bounds[:-1], s.bounds[1:]
        self.prefix = W.prefix_hash(s.data)
        self.count = np.maximum(np.minimum(stop - self.begin - size, self.left) + 1, 0)
        self.row = np.repeat(np.arange(len(self.head)), self.count)
        self.first = np.cumsum(self.count) - self.count
        self.at = np.arange(len(self.row)) - self.first[self.row]  # start inside the context
        self.size = size

    def keys(self, row: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Keys of context bytes ``[a, z)`` for each row number: content, head, and place relative to the head."""
        h = W.span_hash(self.prefix, self.begin[row] + a, self.begin[row] + z)
        place = (self.left[row] - a + 4096).astype(W.U64)
        return W.mix(h + W.mix(self.head[row].view(W.U64) + place * W.U64(0xD6E8FEB86659FD93)))


def _runs(start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges spans that touch; they are sorted by row, then start, and their ends do not fall inside a row."""
    if not len(row):
        return row, start, end
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], end[last]


def _span_batch(b: pa.RecordBatch, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    base = b.column("start").to_numpy()
    return pa.RecordBatch.from_arrays(
        [pa.array(b.column("tk").to_numpy()[row]), pa.array(b.column("n").to_numpy()[row]),
         pa.array((base[row] + start).astype(np.int32)), pa.array((base[row] + end).astype(np.int32))],
        ["tk", "n", "start", "end"])


def _compare(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Spans shared inside whole heads; rows come sorted by head, a few thousand rows are compared at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def flush(t: pa.Table) -> Iterator[pa.RecordBatch]:
        b = t.combine_chunks().to_batches()[0]
        w = _Windows(b, size)
        key = w.keys(w.row, w.at, w.at + size)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twin = np.zeros(len(key) + 1, bool)
        twin[1:-1] |= same
        twin[:-2] |= same
        hit = np.zeros(len(key), bool)
        hit[order] = twin[: len(key)]
        hit &= (b.column("c").to_numpy() == 1)[w.row]  # others are repeated as a whole already
        at = np.flatnonzero(hit)
        yield _span_batch(b, *_runs(w.at[at], w.at[at] + size, w.row[at]))

    for b in batches:
        for k in range(0, b.num_rows, 1000):
            part = b.slice(k, 1000)
            held.append(part)
            rows += part.num_rows
            if rows >= 2000:
                t = pa.Table.from_batches(held)
                heads = t.column("head").to_numpy()
                cut = int(np.searchsorted(heads, heads[-1], "left"))  # the last head may go on
                if cut:
                    yield from flush(t.slice(0, cut))
                    held, rows = t.slice(cut).to_batches(), t.num_rows - cut
    if rows:
        yield from flush(pa.Table.from_batches(held))


def _block_keys(w: _Windows, size: int) -> tuple[np.ndarray, ...]:
    """Blocks of ``BLOCK`` window starts: row, first and last start, key of the bytes that all windows of the block
    share (its core) and of all their bytes (its hull).

    Blocks are counted from the head and the core is that of the block before the ends of the text clip it, so equal
    places give equal cores."""
    n = w.left // BLOCK + 1
    row = np.repeat(np.arange(len(w.count)), n)
    j = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    least, most = w.left[row] - (j + 1) * BLOCK + 1, w.left[row] - j * BLOCK
    lo, hi = np.maximum(least, 0), np.minimum(most, w.count[row] - 1)
    ok = lo <= hi
    row, lo, hi, least, most = row[ok], lo[ok], hi[ok], least[ok], most[ok]
    return row, lo, hi, w.keys(row, most, least + size), w.keys(row, lo, hi + size)


def _in(key: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(key), bool)
    return table[np.minimum(np.searchsorted(table, key), len(table) - 1)] == key


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows that follow each other in one part, as ``part, rows``, at most ``rows`` at a time."""
    for b in batches:
        part = b.column("part").to_numpy()
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            for k in range(i, j, rows):
                yield int(part[k]), b.slice(k, min(rows, j - k))


def _twice(key: np.ndarray) -> np.ndarray:
    """Sorted keys; those that occur again are there twice."""
    k, n = np.unique(key, return_counts=True)
    return np.repeat(k, np.minimum(n, 2))


def _lists(flat: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat))


def _sent(part: int, key: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The keys of a part, one row for each bucket that has some."""
    key = _twice(key)
    to = (key % W.U64(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    bucket, first = np.unique(to[order], return_index=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(np.full(len(bucket), part)),
         _lists(W.signed(key[order]), np.append(first, len(key)))], ["bucket", "part", "keys"])


def _again(sent: DataFrame) -> DataFrame:
    """``part, keys``: to every part those of its keys that occur again, there or in another part.

    Equal keys of all parts meet in one bucket and a part gets back its own keys only, so neither a bucket nor a part
    holds more when a head has more rows."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, p, x) for b in batches for k, p, x in zip(
            b.column("bucket").to_pylist(), b.column("part").to_pylist(), b.column("keys"), strict=True))
        for _, group in groupby(rows, itemgetter(0)):
            parts, lists = zip(*((p, x.values.to_numpy().view(W.U64)) for _, p, x in group), strict=True)
            key = np.sort(np.concatenate(lists))
            again = np.unique(key[1:][key[1:] == key[:-1]])
            for p, x in zip(parts, lists, strict=True):
                x = np.unique(x[_in(x, again)])
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p]), _lists(W.signed(x), np.array([0, len(x)]))], ["part", "keys"])

    n = max(1, partitions(sent.sparkSession))
    return sent.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(met, "part long, keys array<long>")


def _beside(rows: DataFrame, keys: DataFrame, work, schema: str) -> DataFrame:
    """Runs ``work(part, sorted keys, pieces)`` on the rows of each part, with the keys that came back to it."""
    back = keys.withColumnRenamed("keys", "__keys")
    both = back.withColumn("__kind", F.lit(0)).unionByName(rows.withColumn("__kind", F.lit(1)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, group in groupby(_pieces(batches), itemgetter(0)):
            found: list[np.ndarray] = []
            mine = _after_keys((b for _, b in group), found)
            first = next(mine, None)
            if first is not None:
                table = np.sort(np.concatenate(found)) if found else np.empty(0, W.U64)
                yield from work(part, table, chain([first], mine))

    n = max(1, partitions(rows.sparkSession))
    return both.repartition(n, "part").sortWithinPartitions("part", "__kind").mapInArrow(run, schema)


def _after_keys(pieces: Iterator[pa.RecordBatch], found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Adds the keys, which come first, to ``found``; passes the rows."""
    for b in pieces:
        split = int((b.column("__kind").to_numpy() == 0).sum())
        if split:
            found.append(b.column("__keys").slice(0, split).flatten().to_numpy().view(W.U64))
        if split < b.num_rows:
            yield b.slice(split)


_KEYS = "bucket int, part long, keys array<long>"
_PENDING = f"{_KEYS}, tk array<long>, n array<int>, row array<int>, start array<int>, end array<int>, key array<long>, sure array<boolean>"


def _compare_large(rows: DataFrame, scratch: Scratch, size: int) -> DataFrame:
    """The same for heads of many suffixes: their rows are dealt into parts, and the keys of a part travel packed.

    First come the blocks: one whose core occurs once is out, one whose hull occurs again is in.  Then come windows:
    those of the blocks in between, and one row's windows of each hull that is in, since they can be partners.  What
    a row waits for is written with its key, so the contexts are read for the windows and then no more."""
    n = max(1, partitions(rows.sparkSession))
    part = F.xxhash64("head", F.pmod(F.xxhash64("tk", "start"), F.col("deals"))).alias("part")
    rows = rows.select(part, "head", "c", "tk", "n", "start", "left", "bytes")
    rows = scratch.save(rows.repartition(n, "part").sortWithinPartitions("part"), "large")
    buckets = max(n, -(-rows.count() // 16384))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, group in groupby(_pieces(batches), itemgetter(0)):
            keys = []
            for _, b in group:
                _, _, _, core, hull = _block_keys(_Windows(b, size), size)
                keys.append(_twice(np.concatenate([core, hull])))
            yield _sent(part, np.concatenate(keys), buckets)

    def starts(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = hi - lo + 1
        return np.repeat(row, n), np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)

    def windows(part: int, table: np.ndarray, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = []
        for b in pieces:
            w = _Windows(b, size)
            row, lo, hi, core, hull = _block_keys(w, size)
            met = _in(core, table)
            row, lo, hi, hull = row[met], lo[met], hi[met], hull[met]
            sure = _in(hull, table)
            one = np.flatnonzero(sure)
            one = one[np.unique(hull[one], return_index=True)[1]]  # equal hulls hold equal windows
            r1, a1 = starts(row[~sure], lo[~sure], hi[~sure])
            r2, a2 = starts(row[one], lo[one], hi[one])
            wait = w.keys(r1, a1, a1 + size)
            keys.append(_twice(np.concatenate([wait, np.repeat(w.keys(r2, a2, a2 + size), 2)])))
            own = b.column("c").to_numpy() == 1  # others are repeated as a whole already
            yield pending(part, b, np.concatenate([row[sure], r1]), np.concatenate([lo[sure], a1]),
                          np.concatenate([hi[sure], a1]) + size,
                          np.concatenate([np.zeros(int(sure.sum()), W.U64), wait]), int(sure.sum()), own)
        out = _sent(part, np.concatenate(keys), buckets)
        yield pa.RecordBatch.from_arrays(
            [*out.columns, *(pa.nulls(out.num_rows, t) for t in shape.types[3:])], names=shape.names)

    def pending(part: int, b: pa.RecordBatch, row: np.ndarray, lo: np.ndarray, end: np.ndarray, key: np.ndarray, sure: int,
                own: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((lo, row))
        order = order[own[row[order]]]
        have, row = np.unique(row[order], return_inverse=True)
        base = b.column("start").to_numpy()[have][row]
        flat = [b.column("tk").to_numpy()[have], b.column("n").to_numpy()[have], row.astype(np.int32),
                (base + lo[order]).astype(np.int32), (base + end[order]).astype(np.int32), W.signed(key[order]),
                order < sure]
        some = [_lists(x, np.array([0, len(x)])) for x in flat]
        out = pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int32()), pa.array([part]), pa.nulls(1, pa.list_(pa.int64())), *some], names=shape.names)
        return out.slice(0, int(len(have) > 0))

    def spans(part: int, table: np.ndarray, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces:
            for i in range(b.num_rows):
                tk, n, row, start, end, key, sure = (
                    b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in shape.names[3:])
                hit = sure | _in(key.view(W.U64), table)
                row, start, end = _runs(start[hit], end[hit], row[hit])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tk[row]), pa.array(n[row]), pa.array(start), pa.array(end)], ["tk", "n", "start", "end"])

    shape = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("keys", pa.list_(pa.int64())),
                       ("tk", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())), ("row", pa.list_(pa.int32())),
                       ("start", pa.list_(pa.int32())), ("end", pa.list_(pa.int32())), ("key", pa.list_(pa.int64())),
                       ("sure", pa.list_(pa.bool_()))])
    some = _again(rows.mapInArrow(blocks, _KEYS))
    out = scratch.save(_beside(rows, some, windows, _PENDING), "pending")
    scratch.drop("large")
    every = _again(out.where("tk is null").select("bucket", "part", "keys"))
    return _beside(out.where("tk is not null").drop("bucket", "keys"), every, spans, _SPAN)


def repeated_spans(docs: DataFrame, scratch: Scratch, size: int = SIZE, batches: int = BATCHES,
                   together: int = TOGETHER) -> DataFrame:
    """``tk, n, spans``: byte spans (start, end pairs, unmerged) that occur again, for texts held by one row."""
    every = suffixes(docs, size).withColumn("batch", F.pmod("tk", F.lit(batches)))
    scratch.save(every, "suffixes", by=["batch"])
    family = IndexFamily(scratch)
    for k in range(batches):
        family.insert(scratch.load("suffixes", every.schema).where(F.col("batch") == k).drop("batch"))
    scratch.drop("suffixes")
    met = scratch.save(family.met(), "met")
    scratch.drop(*family.levels.values(), *family.hits)
    classes = met.groupBy("head", "ctx").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("tk", "n", "pos")).alias("r"))
    whole = salted_join(met, classes.where("c > 1").select("head", "ctx"), ["head", "ctx"], "tk", how="inner").select(
        "tk", "n", F.greatest(F.col("pos") - (size - HEAD), F.lit(0)).alias("start"),
        F.least(F.col("pos") + size, F.col("n")).alias("end"))
    per_head = classes.groupBy("head").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("least")).where("m > 1 and least = 1")
    per_head = per_head.select("head", F.ceil(F.col("m") / together).cast("int").alias("deals"))
    want = salted_join(classes, per_head, ["head"], "ctx", how="inner").groupBy("r.tk", "r.n").agg(
        F.collect_list(F.struct("head", "c", "deals", "r.pos")).alias("want"))
    want = scratch.save(want, "want")
    texts = documents(docs).select("doc_id", "text", *_text_key())
    texts = maybe_in(texts, want, "tk")
    one = texts.groupBy("tk", "n").agg(F.min("doc_id").alias("doc_id"))  # one row of each text
    cut = map_texts(texts.join(want.join(one, ["tk", "n"]).withColumnRenamed("doc_id", "__one"), ["tk", "n"])
                    .where(F.col("doc_id").eqNullSafe(F.col("__one"))).select("tk", "n", "want", "text"),
                    lambda b: (x for p in _few(b) for x in _contexts(p, size)), _CONTEXT)
    cut = scratch.save(cut, "contexts").distinct()
    few = cut.where("deals = 1").repartition(max(1, partitions(docs.sparkSession)), "head").sortWithinPartitions("head")
    near = few.mapInArrow(lambda bs: _compare(bs, size), _SPAN)
    spans = whole.unionByName(near)
    if cut.where("deals > 1").limit(1).count():
        spans = spans.unionByName(_compare_large(cut.where("deals > 1"), scratch, size))
    return spans.groupBy("tk", "n").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _apply(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    removed, count, digests, merged = [], [], [], []
    for spans, text in zip(b.column("spans").to_pylist(), b.column("text").to_pylist(), strict=True):
        raw, flat = (text or "").encode(), []
        for a, z in sorted((x["start"], x["end"]) for x in spans):
            if flat and a <= flat[-1]:
                flat[-1] = max(flat[-1], z)
            else:
                flat += [a, z]
        h, at = hashlib.sha256(), 0
        for a, z in zip(flat[::2], flat[1::2], strict=True):
            h.update(raw[at:a])
            at = z
        h.update(raw[at:])
        removed.append(sum(flat[1::2]) - sum(flat[::2]))
        count.append(len(flat) // 2)
        digests.append(h.hexdigest())
        merged.append(flat)
    yield pa.RecordBatch.from_arrays(
        [b.column("tk"), b.column("n"), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digests),
         pa.array(merged, pa.list_(pa.int32()))], ["tk", "n", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove_repeats(docs: DataFrame, size: int = SIZE, batches: int = BATCHES, together: int = TOGETHER) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (merged byte spans that go)."""
    scratch = Scratch(docs.sparkSession, "suffix")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(docs).select("doc_id", *_text_key(), F.sha2(text, 256).alias("own"))
    copies = rows.groupBy("tk", "n").agg(F.count(F.lit(1)).alias("c")).where(f"c > 1 and n >= {size}")
    copies = scratch.save(copies.select("tk", "n", F.lit(True).alias("copied")), "copies")
    spans = scratch.save(repeated_spans(docs, scratch, size, batches, together).join(copies, ["tk", "n"], "left_anti"), "spans")
    scratch.drop("met", "want", "contexts", "pending")
    texts = maybe_in(documents(docs).select("text", *_text_key()), spans, "tk")
    done = map_texts(texts.join(spans, ["tk", "n"]),
                     lambda b: (x for p in _few(b) for x in _apply(p)),
                     "tk long, n int, n_removed long, n_spans long, kept_sha256 string, spans array<int>")
    done = done.withColumnRenamed("spans", "cut")
    rows = salted_join(rows, copies, ["tk", "n"], "doc_id").join(done, ["tk", "n"], "left")
    gone = F.col("copied").isNotNull()
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_bytes"),
        F.when(gone, F.col("n").cast("long")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "own")).alias("kept_sha256"),
        F.when(gone, F.array(F.lit(0), F.col("n"))).otherwise(F.coalesce("cut", F.array().cast("array<int>"))).alias("spans"))
