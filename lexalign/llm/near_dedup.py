"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on full shingle sets.

A document's set holds its distinct shingles.  Equal sets are one node.  Each of ``TREES`` trees orders the nodes by two
MinHash values of its own; nodes that share both form a region.  Two sets of similarity 0.8 miss each other in all 24
trees with probability 2e-11.  Inside a region every pair is compared: in one go up to ``REGION`` nodes, else in a grid
of blocks of about ``SPAN`` nodes.  Pairs whose whole signatures agree enough make candidate families; a block pair
only returns edges that join something (a spanning forest), so a large family of copies makes no square of rows.

Each family's sets then meet in one task (large families in a grid of tasks of bounded size), which compares every pair
of the family that is not connected yet, in full; true links give the components.

Defined cases: a text with fewer words than a shingle is one shingle, a text without words or null is empty and linked
with nothing; rows with equal sets are linked whatever their ids; a null ``doc_id`` counts as the largest id; an empty
table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .tables import Scratch, documents, map_texts, maybe_in, null_last, partitions, salted_join

TREES = 24
VALUES = 2 * TREES
REGION = 16
#: nodes that a block of a large region may hold
SPAN = 8192
#: least number of agreeing signature values: similarity 0.8 falls below with probability 1e-9
AGREE = 20
#: shingles that a block of a family may hold
BLOCK = 3_000_000

_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(1 << 63, size=VALUES, dtype=W.U64) | W.U64(1)


def shingle_sets(s: W.Slice, kind: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text in a row, and the bounds of each text's part."""
    w = W.words(s, kind)
    h = W.chain(w.hash, n)
    out, bounds = [], [0]
    for k in range(len(s)):
        a, z = int(w.first[k]), int(w.first[k + 1])
        if z - a >= n:
            mine = np.unique(h[a : z - n + 1])
        elif z > a:
            mine = W.chain(w.hash[a:z], z - a)
        else:
            mine = h[:0]
        out.append(mine)
        bounds.append(bounds[-1] + len(mine))
    return (np.concatenate(out) if out else h[:0]), np.array(bounds)


def _nodes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each non-empty set (0 for empty ones): a sum, so the order does not matter."""
    size = np.diff(bounds)
    full = size > 0
    node = np.zeros(len(size), W.U64)
    if full.any():
        node[full] = W.mix(np.add.reduceat(W.mix(h), bounds[:-1][full]) + W.mix(size[full].astype(W.U64)))
    return node


def _minhash(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """32-bit MinHash values of each set, zeros for empty ones."""
    full = np.diff(bounds) > 0
    sig = np.zeros((len(full), VALUES), np.uint32)
    if full.any():
        at = bounds[:-1][full]
        for v in range(VALUES):
            x = h * _MULT[v]
            sig[full, v] = np.minimum.reduceat((x >> W.U64(32)).astype(np.uint32), at)
    return sig


def _signatures(b: pa.RecordBatch, kind: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """``node`` (hash of the set), its size and the 32-bit MinHash values."""
    for s in W.slices(b.column("text")):
        h, bounds = shingle_sets(s, kind, n)
        size = np.diff(bounds)
        node, sig = _nodes(h, bounds), _minhash(h, bounds)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").slice(s.first, len(s)), b.column("h").slice(s.first, len(s)), pa.array(W.signed(node)), pa.array(size.astype(np.int64)),
             pa.array([r.tobytes() for r in sig], pa.binary())], ["doc_id", "h", "node", "n", "sig"])


def _values(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, VALUES)


def _top(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Keys of the two values of each tree."""
    sig, node = _values(b), b.column("node").to_numpy()
    for t in range(TREES):
        key = W.mix(np.full(len(sig), t * 1009 + 2, W.U64))
        for v in (2 * t, 2 * t + 1):
            key = W.mix(key + sig[:, v].astype(W.U64))
        yield pa.RecordBatch.from_arrays([pa.array(W.signed(key)), pa.array(node)], ["key", "node"])


def _pairs(batches: Iterator[pa.RecordBatch], reach: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Compares rows of equal ``key`` that are at most ``reach`` apart; keeps pairs that can be similar enough."""
    tail: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b]) if tail is None else pa.concat_tables([tail, pa.Table.from_batches([b])])
        t = t.combine_chunks()
        one = t.to_batches()[0]
        sig, key = _values(one), one.column("key").to_numpy()
        node, n = one.column("node").to_numpy(), one.column("n").to_numpy()
        skip = 0 if tail is None else tail.num_rows
        rows: list[list[np.ndarray]] = [[], []]
        for d in range(1, min(reach, len(key) - 1) + 1):
            i = np.arange(max(0, skip - d), len(key) - d)
            i = i[(key[i] == key[i + d]) & (node[i] != node[i + d])]
            i = i[100 * np.minimum(n[i], n[i + d]) >= percent * np.maximum(n[i], n[i + d])]
            ok = (sig[i] == sig[i + d]).sum(axis=1) >= AGREE
            rows[0].append(np.minimum(node[i], node[i + d])[ok])
            rows[1].append(np.maximum(node[i], node[i + d])[ok])
        if rows[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(r)) for r in rows], ["a", "b"])
        tail = t.slice(max(0, t.num_rows - reach))


def _forest(sig: np.ndarray, n: np.ndarray, half: np.ndarray | None, percent: int,
            true: Callable[[int, np.ndarray], np.ndarray] | None = None) -> list[tuple[int, np.ndarray]]:
    """Edges ``(x, ys)`` of a spanning forest of all pairs that are near, or of those between the halves of the rows.

    A search from each row that is not reached yet: every row meets all rows that no row before it has reached.
    Near pairs have fitting sizes and signatures that agree enough; ``true(x, ys)`` says which of them count."""
    order = np.argsort(n, kind="stable")
    rest = [order] if half is None else [order[half[order] == k] for k in (0, 1)]
    kept = [(r, n[r], sig[r]) for r in rest]  # not reached yet, by size
    last = len(kept) - 1
    out: list[tuple[int, np.ndarray]] = []
    while all(len(k[0]) for k in kept):
        root = int(kept[0][0][0])
        kept[0] = tuple(c[1:] for c in kept[0])
        queue = deque([(root, 0)])
        while queue:
            x, side = queue.popleft()
            other = last - side
            row, size, values = kept[other]
            if not len(row):
                if not any(len(k[0]) for k in kept):
                    break
                continue
            a = int(np.searchsorted(size, -(-percent * int(n[x]) // 100)))
            z = int(np.searchsorted(size, 100 * int(n[x]) // percent, "right"))
            hit = a + np.flatnonzero((values[a:z] == sig[x]).sum(axis=1) >= AGREE)
            if len(hit) and true is not None:
                hit = hit[true(x, row[hit])]
            if len(hit):
                out.append((x, row[hit]))
                queue.extend((int(y), other) for y in row[hit])
                kept[other] = tuple(np.delete(c, hit, axis=0) for c in kept[other])
    return out


def _grid(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """The rows of each block pair, as lists by column; rows come sorted by ``keys``."""
    now, held = None, {}
    for b in batches:
        cols = {c: b.column(c).to_pylist() for c in b.schema.names}
        marks = list(zip(*(cols[k] for k in keys), strict=True))
        a = 0
        for z in [*(k for k in range(1, len(marks)) if marks[k] != marks[k - 1]), len(marks)]:
            if a < z:
                if marks[a] != now:
                    if held:
                        yield now, held
                    now, held = marks[a], {c: [] for c in cols}
                for c in cols:
                    held[c] += cols[c][a:z]
                a = z
    if held:
        yield now, held


def _edges(forest: list[tuple[int, np.ndarray]], node: np.ndarray) -> pa.RecordBatch:
    a = np.concatenate([np.full(len(y), x) for x, y in forest] or [np.empty(0, int)]).astype(int)
    b = np.concatenate([y for _, y in forest] or [np.empty(0, int)]).astype(int)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b]))], ["a", "b"])


def _halves(block: tuple, k: list[int]) -> np.ndarray | None:
    """Which rows are of the second block; none where a block meets itself."""
    return None if block[-2] == block[-1] else (np.array(k) == block[-1]).astype(int)


def _spread(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the candidates of the block pairs of large regions."""
    for block, c in _grid(batches, ["key", "i", "j"]):
        sig = np.frombuffer(b"".join(c["sig"]), np.uint32).reshape(-1, VALUES)
        yield _edges(_forest(sig, np.array(c["n"], np.int64), _halves(block, c["k"]), percent), np.array(c["node"], np.int64))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of block ``k`` out of ``g`` go to every block pair ``i, j`` that has ``k``."""
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    return rows.withColumn("i", F.least("k", "other")).withColumn("j", F.greatest("k", "other")).drop("g", "other")


def candidates(reps: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """``a, b``: pairs of nodes that connect whatever shares a region of any tree and can be similar enough."""
    n = max(1, partitions(reps.sparkSession))
    top = scratch.save(map_texts(reps.select("node", "sig"), _top, "key long, node long"), "top")
    size = top.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    met = scratch.save(salted_join(top, size, ["key"], "node", how="inner"), "met")
    scratch.drop("top")
    sigs = reps.select("node", "n", "sig")
    pair = "a long, b long"
    small = met.where(F.col("c") <= REGION).select("key", "node").join(sigs, "node").select("key", "node", "n", "sig")
    small = small.repartition(n, "key").sortWithinPartitions("key", "node")
    found = small.mapInArrow(lambda bs: _pairs(bs, REGION - 1, percent), pair)
    large = met.where(F.col("c") > REGION).withColumn("g", F.ceil(F.col("c") / SPAN).cast("int")).withColumn(
        "k", F.pmod(F.xxhash64("node"), F.col("g")).cast("int"))
    large = _blocks(large.select("key", "node", "g", "k").join(sigs, "node"))
    large = large.select("key", "i", "j", "k", "node", "n", "sig").repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return found.unionByName(large.mapInArrow(lambda bs: _spread(bs, percent), pair)).distinct()


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Compares all sets of each block pair of a family; emits the links that join something."""
    for block, c in _grid(batches, ["fam", "i", "j"]):
        sets = [np.frombuffer(raw, W.U64) for raw in c["bytes"]]
        size = np.array([len(x) for x in sets], np.int64)
        h = np.concatenate(sets)

        def true(x: int, ys: np.ndarray, sets: list[np.ndarray] = sets, size: np.ndarray = size) -> np.ndarray:
            own, many = sets[x], size[ys]
            all_ = np.concatenate([sets[y] for y in ys])
            same = own[np.minimum(np.searchsorted(own, all_), len(own) - 1)] == all_
            both = np.add.reduceat(same.astype(np.int64), np.cumsum(many) - many)
            return 100 * both >= percent * (len(own) + many - both)

        # few sets are all compared in full: equal signatures rule nothing out
        few = len(sets) <= REGION
        sig = np.zeros((len(sets), VALUES), np.uint32) if few else _minhash(h, np.concatenate([[0], np.cumsum(size)]))
        yield _edges(_forest(sig, size, _halves(block, c["k"]), percent, true), np.array(c["node"], np.int64))


def links(docs: DataFrame, reps: DataFrame, pairs: DataFrame, scratch: Scratch, kind: np.ndarray, n: int,
          percent: int) -> DataFrame:
    """``a, b``: confirmed links, enough of them to connect what is connected inside each block of a family."""
    family = components(pairs, scratch, "family").withColumnRenamed("comp", "fam")
    member = scratch.save(family.join(reps.select("node", "n", "id"), "node"), "member")
    weight = member.groupBy("fam").agg(F.sum("n").alias("w")).select("fam", F.ceil(F.col("w") / BLOCK).cast("int").alias("g"))
    member = salted_join(member, weight, ["fam"], "node", how="inner").withColumn(
        "k", F.pmod(F.xxhash64("node"), F.col("g")).cast("int"))
    member = scratch.save(member, "bucket")

    def sets(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for s in W.slices(b.column("text")):
            h, bounds = shingle_sets(s, kind, n)
            part = b.slice(s.first, len(s))
            # an id may come with several texts: only the one with the wanted set counts
            ok = np.flatnonzero(W.signed(_nodes(h, bounds)) == part.column("node").to_numpy())
            raw = [h[bounds[k] : bounds[k + 1]].tobytes() for k in ok.tolist()]
            own = [part.column(c).take(pa.array(ok)) for c in ("fam", "g", "k", "node")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(raw, pa.binary())], ["fam", "g", "k", "node", "bytes"])

    texts = maybe_in(documents(docs).withColumn("id", null_last("doc_id")), member, "id").join(
        member.select("id", "fam", "g", "k", "node"), "id").select("fam", "g", "k", "node", "text")
    own = map_texts(texts, sets, "fam long, g int, k int, node long, bytes binary").distinct()
    rows = _blocks(own).repartition(max(1, partitions(docs.sparkSession)), "fam", "i", "j").sortWithinPartitions("fam", "i", "j")
    return rows.mapInArrow(lambda bs: _confirm(bs, percent), "a long, b long")


def linked(docs: DataFrame, scratch: Scratch, kind: np.ndarray, n: int, percent: int) -> DataFrame:
    """Per row: ``doc_id, id`` (null: the largest), ``h`` (hash of the text), ``n`` and ``first``, the smallest id reached."""
    every = documents(docs).withColumn("h", F.xxhash64("text"))
    every = scratch.save(map_texts(every, lambda b: _signatures(b, kind, n), "doc_id long, h long, node long, n long, sig binary")
                         .withColumn("id", null_last("doc_id")), "docs")
    reps = scratch.save(every.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.min("n").alias("n"),
                                                                F.min("sig").alias("sig")), "reps")
    pairs = scratch.save(candidates(reps, scratch, percent), "pairs")
    true = scratch.save(links(docs, reps, pairs, scratch, kind, n, percent), "links")
    comp = components(true, scratch, "linked")
    member = reps.select("node", "id").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = member.groupBy("comp").agg(F.min("id").alias("component_id"))
    where = scratch.save(salted_join(member, least, ["comp"], "node").select("node", "component_id"), "where")
    out = salted_join(every.select("doc_id", "id", "h", "node", "n"), where, ["node"], "id")
    return out.select("doc_id", "id", "h", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("first"))


def near_duplicates(docs: DataFrame, kind: np.ndarray = W.ALNUM, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (smallest id that links reach), ``kept``."""
    out = linked(docs, Scratch(docs.sparkSession, "near"), kind, n, percent)
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNull() & (F.col("first") == F.col("id")), F.lit(None)).otherwise(
                          F.col("first")).alias("component_id"), (F.col("first") == F.col("id")).alias("kept"))


def keep_one(docs: DataFrame, kind: np.ndarray = W.ALNUM, n: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, with all their columns: one of each group of linked rows, and every row without words.

    The smallest id stays; of several rows of that id the one with the smallest text hash, and one of equal rows."""
    scratch = Scratch(docs.sparkSession, "near")
    out = linked(docs, scratch, kind, n, percent)
    one = out.where("n > 0 and first = id").groupBy("first").agg(F.min("h").alias("__h")).select(
        F.col("first").alias("__id"), "__h", F.lit(True).alias("__single"))
    empty = out.where("n = 0").select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.lit(False).alias("__single"))
    keep = scratch.save(one.unionByName(empty).distinct(), "keep")
    rows = docs.withColumn("__id", null_last(F.col("doc_id").cast("long"))).withColumn("__h", F.xxhash64(F.col("text").cast("string")))
    rows = rows.join(keep, ["__id", "__h"]).withColumn(
        "__k", F.row_number().over(Window.partitionBy("__id", "__h").orderBy("__single")))
    return rows.where("not __single or __k = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
