"""Packing by cutting-stock column generation.

Documents become token ids, full sequences are cut off first, and the rests are counted by length class.  The
histogram (at most ``seq / unit`` numbers, however large the corpus) goes to a linear program over packing patterns:
a basis of patterns gives prices, a knapsack dynamic program over these prices finds the best new pattern, until none
pays.  Rounded-down patterns and a first-fit packing of what is left give every class a list of slots, and the
documents, ranked inside their class, take the slots in order.

Defined cases: a null or empty text is the end token alone; repeated rows and ids are pieces of their own, told apart
by rank; a null ``doc_id`` stays null; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .bpe import Encoder
from .tables import Scratch, documents, map_texts, partitions

SEQ = 2048
UNIT = 16
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_encoders: dict[int, Encoder] = {}


def token_pieces(docs: DataFrame, spec: str, end_id: int = 1, seq: int = SEQ) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: full pieces of ``seq`` ids and a rest for each row.

    ``spec`` is the content of a tokenizer file; it is broadcast, as files of the driver need not exist elsewhere.
    """
    sent = docs.sparkSession.sparkContext.broadcast(spec)

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        enc = _encoders.get(sent.id if hasattr(sent, "id") else 0)
        if enc is None:
            _encoders.clear()
            enc = _encoders[sent.id if hasattr(sent, "id") else 0] = Encoder(sent.value)
        doc_ids = b.column("doc_id")
        for s in W.slices(b.column("text")):
            ids, bounds = enc.encode(s)
            row, start, length, crc, total = [], [], [], [], []
            for k in range(len(s)):
                mine = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id)).astype("<u4")
                for a in range(0, len(mine), seq):
                    piece = mine[a : a + seq]
                    row.append(s.first + k)
                    start.append(a)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(mine))
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(row, pa.int64()))] + [pa.array(x, pa.int64()) for x in (start, length, crc, total)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return map_texts(documents(docs), work, _PIECES)


def _best_pattern(sizes: list[int], price: np.ndarray, room: int) -> tuple[float, list[int]]:
    """Unbounded knapsack: the most valuable pattern that fits into ``room``, as a count per size."""
    best, last, z = np.zeros(room + 1), np.full(room + 1, -1), np.array(sizes)
    for w in range(1, room + 1):
        k = int(np.searchsorted(z, w, "right"))
        best[w] = best[w - 1]
        if k:
            gain = best[w - z[:k]] + price[:k]
            i = int(gain.argmax())
            if gain[i] > best[w] + 1e-12:
                best[w], last[w] = gain[i], i
    pattern, w = [0] * len(sizes), room
    while w > 0:
        if last[w] < 0:
            w -= 1
        else:
            pattern[last[w]] += 1
            w -= sizes[last[w]]
    return float(best[room]), pattern


def _inverse(basis: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots; at most ``seq / unit`` rows, so threads of a BLAS would only get in the way."""
    n = len(basis)
    m = np.hstack([basis, np.eye(n)])
    for i in range(n):
        j = i + int(np.abs(m[i:, i]).argmax())
        m[[i, j]] = m[[j, i]]
        m[i] /= m[i, i]
        rest = m[:, i].copy()
        rest[i] = 0
        m -= np.outer(rest, m[i])
    return m[:, n:]


def patterns(demand: dict[int, int], room: int, rounds: int = 3000) -> list[tuple[int, dict[int, int]]]:
    """``(copies, {size: count})`` that cover ``demand`` (size -> items) exactly, in bins of ``room`` units.

    Every item of the demand has a slot; ``rounds`` only ends the price search early (any basis is feasible).
    """
    sizes = sorted(z for z, n in demand.items() if n > 0)
    if not sizes:
        return []
    need = np.array([demand[z] for z in sizes], float)
    basis = np.diag([float(room // z) for z in sizes])
    inverse = np.diag(1 / basis.diagonal())
    apart = need + 1e-3 * np.random.default_rng(1).random(len(need))  # no ties, so the search cannot cycle
    for k in range(rounds):
        value, column = _best_pattern(sizes, inverse.sum(axis=0), room)
        if value <= 1 + 1e-7:
            break
        column = np.array(column, float)
        use, move = np.maximum((inverse * apart).sum(axis=1), 0), (inverse * column).sum(axis=1)
        out_row = int(np.argmin(np.where(move > 1e-9, use / np.where(move > 1e-9, move, 1), np.inf)))
        basis[:, out_row] = column
        if k % 100 == 99:
            inverse = _inverse(basis)  # rounding errors of the updates go
        else:
            pivot = inverse[out_row] / move[out_row]
            inverse -= np.outer(move, pivot)
            inverse[out_row] = pivot
    copies = np.floor(np.maximum((_inverse(basis) * need).sum(axis=1), 0) + 1e-9).astype(int)
    left = dict(zip(sizes, (int(n) for n in need), strict=True))
    out: list[tuple[int, dict[int, int]]] = []
    for j, n in enumerate(copies.tolist()):
        counts = {z: int(round(basis[i, j])) for i, z in enumerate(sizes) if basis[i, j] > 0.5}
        n = min([n, *(left[z] // c for z, c in counts.items())])
        if n > 0:
            out.append((n, counts))
            for z, c in counts.items():
                left[z] -= n * c
    bins: list[list] = []  # first fit, largest first, for the remainder of the rounding
    for z in reversed(sizes):
        for _ in range(left[z]):
            b = next((b for b in bins if b[0] >= z), None)
            if b is None:
                bins.append(b := [room, {}])
            b[0] -= z
            b[1][z] = b[1].get(z, 0) + 1
    return out + [(1, b[1]) for b in bins]


def _slots(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """Per class: rows (first rank, count in the pattern, first sequence, first slot), ordered by first rank."""
    rank: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for copies, counts in plan:
        slot = 0
        for z, c in sorted(counts.items(), reverse=True):
            out.setdefault(z, []).append((rank.get(z, 0), c, sequence, slot))
            rank[z] = rank.get(z, 0) + copies * c
            slot += c
        sequence += copies
    return {z: np.array(v, np.int64) for z, v in out.items()}


def _assign(b: pa.RecordBatch, slots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    kind, rank = b.column("kind").to_numpy(), b.column("rank").to_numpy()
    sequence, slot = np.empty(len(kind), np.int64), np.empty(len(kind), np.int64)
    for z in np.unique(kind).tolist():
        at = np.flatnonzero(kind == z)
        t = slots[z]
        row = t[np.searchsorted(t[:, 0], rank[at], "right") - 1]
        k = rank[at] - row[:, 0]
        sequence[at], slot[at] = row[:, 2] + k // row[:, 1], row[:, 3] + k % row[:, 1]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(sequence), pa.array(slot)],
                                     [*names, "sequence_id", "slot"])


def pack(docs: DataFrame, spec: str, end_id: int = 1, seq: int = SEQ, unit: int = UNIT) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; a sequence holds at most ``seq`` ids.

    Ranks inside a class come from counts per (class, hash bucket) and row numbers inside a bucket, so a class that
    holds a third of all pieces is ranked by many tasks.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    buckets = max(1, partitions(spark))
    pieces = token_pieces(docs, spec, end_id, seq).select(
        "*", F.ceil(F.col("length") / unit).cast("int").alias("kind"),
        F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int").alias("bucket"))
    pieces = scratch.save(pieces, "pieces")
    counts = pieces.groupBy("kind", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("kind", "bucket", (F.sum("n").over(
        Window.partitionBy("kind").orderBy("bucket")) - F.col("n")).alias("before"))
    demand = {r.kind: r.n for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # <= seq / unit rows
    slots = _slots(patterns(demand, seq // unit))
    inside = Window.partitionBy("kind", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.join(before, ["kind", "bucket"]).withColumn(
        "rank", (F.col("before") + F.row_number().over(inside) - 1).cast("long"))
    placed = map_texts(ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "kind", "rank"),
                       lambda b: _assign(b, slots), _PIECES + ", sequence_id long, slot long")
    order = Window.partitionBy("sequence_id").orderBy("slot")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         (F.sum("length").over(order) - F.col("length")).alias("offset"))
