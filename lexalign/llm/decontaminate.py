"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams, scanned against all windows
of the training texts; hits are verified on the words themselves before spans or documents go.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters.  A window is ``n`` consecutive
words of an item; an item of fewer words (but not none) is one window.  The set is dealt into blocks of at most
``BLOCK`` windows, so what is broadcast has a fixed bound; every block scans all documents.

Defined cases: null and empty texts have no words and no hits; repeated rows are scanned each on their own; item
rows with the same id are one item; a null item id is the empty string; empty tables give no hits or no rows;
only ``doc_id``/``item_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.session import checkpoint_dir

from . import words as W
from .tables import documents, map_texts

#: windows of a broadcast block (about 100 bytes each)
BLOCK = 200_000
_BITS = 22
_SCAN = "doc_id long, text string, n_words long, spans array<int>, items array<string>"


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``item, words, gram``: the distinct windows (words joined by one blank) of each item."""

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        items, size, grams = [], [], []
        ids = b.column("item").to_pylist()
        for s in W.slices(b.column("text")):
            w = W.words(s, W.ALNUM)
            for k in range(len(s)):
                tokens = [bytes(w.low[w.start[j] : w.end[j]]) for j in range(w.first[k], w.first[k + 1])]
                m = min(n, len(tokens))
                for g in {b" ".join(tokens[i : i + m]) for i in range(len(tokens) - m + 1)} if m else ():
                    items.append(ids[s.first + k])
                    size.append(m)
                    grams.append(g.decode())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(size, pa.int32()),
                                          pa.array(grams, pa.string())], ["item", "words", "gram"])

    src = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                           F.col("text").cast("string").alias("text"))
    return map_texts(src, work, "item string, words int, gram string").distinct()


class _Set:
    """The windows of one block: sorted hashes, a bit table in front of them, the windows and their items."""

    def __init__(self, rows: list[tuple[str, str]]):
        grams: dict[bytes, list[str]] = {}
        for item, gram in rows:
            grams.setdefault(gram.encode(), []).append(item)
        keys = sorted(grams)
        by_len: dict[int, list[bytes]] = {}
        for g in keys:
            by_len.setdefault(g.count(b" ") + 1, []).append(g)
        self.tables = {}
        for m, gs in by_len.items():
            h = np.empty(len(gs), W.U64)
            for i, g in enumerate(gs):
                s = W.Slice(0, np.frombuffer(g, np.uint8), np.array([0, len(g)]))
                h[i] = W.chain(W.words(s, W.ALNUM).hash, m)[0]
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << _BITS, bool)
            bits[h & W.U64((1 << _BITS) - 1)] = True
            self.tables[m] = (h[order], bits, [gs[i] for i in order], [grams[gs[i]] for i in order])


def _hits(texts: pa.Array, block: _Set) -> Iterator[tuple]:
    """Per slice: the slice, its words, hit spans by text (word numbers inside the text), and items by text."""
    for s in W.slices(texts):
        w = W.words(s, W.ALNUM)
        found: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        doc = w.doc()
        for m, (table, bits, grams, owners) in block.tables.items():
            h = W.chain(w.hash, m)
            at = np.flatnonzero(bits[h & W.U64((1 << _BITS) - 1)])
            at = at[doc[at] == doc[at + m - 1]]
            lo = np.searchsorted(table, h[at], "left")
            hi = np.searchsorted(table, h[at], "right")
            for i, a, z in zip(at[lo < hi].tolist(), lo[lo < hi].tolist(), hi[lo < hi].tolist(), strict=True):
                here = b" ".join(bytes(w.low[w.start[j] : w.end[j]]) for j in range(i, i + m))
                for k in range(a, z):
                    if grams[k] == here:
                        d = int(doc[i])
                        found.setdefault(d, []).append((i - int(w.first[d]), i - int(w.first[d]) + m))
                        items.setdefault(d, set()).update(owners[k])
        yield s, w, found, items


def _scan(b: pa.RecordBatch, block: _Set) -> Iterator[pa.RecordBatch]:
    """Adds a block's hits to ``spans`` (word positions start, end, start, end, ...) and ``items``."""
    for s, w, found, items in _hits(b.column("text"), block):
        part = b.slice(s.first, len(s))
        old_spans, old_items = part.column("spans").to_pylist(), part.column("items").to_pylist()
        spans = [merge(o, found[k]) if k in found else o for k, o in enumerate(old_spans)]
        names = [sorted(items[k].union(o)) if k in items else o for k, o in enumerate(old_items)]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text"), pa.array(np.diff(w.first), pa.int64()),
             pa.array(spans, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))],
            ["doc_id", "text", "n_words", "spans", "items"])


def _filter(b: pa.RecordBatch, block: _Set) -> Iterator[pa.RecordBatch]:
    for s, _, found, _ in _hits(b.column("text"), block):
        yield b.slice(s.first, len(s)).filter(pa.array([k not in found for k in range(len(s))], pa.bool_()))


def merge(flat: list[int], more: list[tuple[int, int]]) -> list[int]:
    """Union of half-open spans as a flat, sorted list."""
    out: list[int] = []
    for a, z in sorted([*zip(flat[::2], flat[1::2], strict=True), *more]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], z)
        else:
            out += [a, z]
    return out


def _each_block(df: DataFrame, benchmark: DataFrame, n: int, block: int, work, schema) -> DataFrame:
    """Applies ``work(batch, set)`` for every block of the benchmark's windows, one after the other."""
    windows = benchmark_windows(benchmark, n)
    blocks = max(1, -(-windows.count() // block))
    for i in range(blocks):
        mine = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == i)
        sent = df.sparkSession.sparkContext.broadcast(_Set([(r.item, r.gram) for r in mine.select("item", "gram").collect()]))
        df = map_texts(df, lambda b, sent=sent: work(b, sent.value), schema)
        if i + 1 < blocks:
            checkpoint_dir(df.sparkSession)
            df = df.checkpoint()
    return df


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, block: int = BLOCK) -> DataFrame:
    """``doc_id, text, n_words, spans, items`` per row: merged spans of hit words, and the items that occur."""
    out = documents(docs).select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                                 F.array().cast("array<int>").alias("spans"),
                                 F.array().cast("array<string>").alias("items"))
    return _each_block(out, benchmark, n, block, _scan, _SCAN)


def keep_clean(docs: DataFrame, benchmark: DataFrame, n: int = 10, block: int = BLOCK) -> DataFrame:
    """Rows of ``docs``, with all their columns, that hold no window of the benchmark."""
    return _each_block(docs, benchmark, n, block, _filter, docs.schema)


def _cut(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Removes the bytes of hit words (from a span's first word to its last)."""
    for s in W.slices(b.column("text")):
        w = W.words(s, W.ALNUM)
        part = b.slice(s.first, len(s))
        texts = []
        for k, flat in enumerate(part.column("spans").to_pylist()):
            f, raw, at = int(w.first[k]), s.data, int(s.bounds[k])
            pieces = []
            for a, z in zip(flat[::2], flat[1::2], strict=True):
                pieces.append(bytes(raw[at : w.start[f + a]]))
                at = int(w.end[f + z - 1])
            texts.append(b"".join([*pieces, bytes(raw[at : s.bounds[k + 1]])]).decode())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents") -> DataFrame:
    """Documents without benchmark passages: ``remove`` hit ``documents``, or only the hit ``spans``."""
    if remove == "documents":
        return keep_clean(documents(docs), benchmark, n)
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    found = scan(docs, benchmark, n)
    return map_texts(found.select("doc_id", "text", "spans"), _cut, "doc_id long, text string")
