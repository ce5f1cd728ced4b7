"""Spelling variants: groups of words that differ by one code point, found by dynamic programming over sorted lists.

1. **Words** (``vocabulary``): runs of letters of whole texts, counted in the tasks before they are shuffled.  The
   contract deletes a code point of some runs (a checksum of document and run decides); that is the ``slip`` function.
   All letters are at most U+00FF, so a word is one byte a code point inside the tasks and byte order is code-point order.
2. **Lists** (``neighbours``): of two near words let ``L`` be the shorter length and ``h = L // 2``.  They share their
   first ``h`` code points, or else their last ``L - h``.  So a word joins four sorted lists: for ``L`` = its length and
   one less, by its first ``h`` and, reversed, by its last ``L - h`` code points.  A pair that both kinds of list hold
   counts in the first alone.
3. **Scan**: every word of length ``L`` reads its sorted list.  Rows of the edit matrix are banded to one cell on either
   side of the diagonal; a row belongs to a depth (code points of the list's word), so the rows of the prefix that two
   adjacent words share (their LCP) are kept.  As soon as all cells of a row exceed one edit, all words that share the
   prefix read so far are skipped: the next word is the first with a smaller LCP.  All words of a chunk take their
   steps together, in arrays.
4. Lists of more than ``BLOCK`` words are cut into blocks by a hash, and block meets block (a grid).
5. A task hands out one row per word: how many near words it met and the best of them.  Counts add up, as a pair meets
   in exactly one list.
6. **Forms and roots**: a form occurs at least ``factor`` times as often, so a chain of forms has at most
   ``log(largest count)`` links; roots come from joins that double the links they follow.

Cases: a null text has no words; a null ``doc_id`` enters the checksum as an empty string.  Rows that repeat an id count
each for themselves.  Words of equal count tie by code-point order.  Very long words are words like others.  Other
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import Scratch, documents, map_texts, partitions

LEAST, TWICE, FACTOR, SLIP = 7, 2, 10, 31
#: words of a list that one task reads at most on either side, and rows scanned at a time
BLOCK = 8192
CHUNK = 1 << 17
#: cells of the tables that lead from a word to the next with a smaller LCP
CELLS = 1 << 24
_FAR = np.uint8(9)


def _letter_runs(s: W.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the runs ``[A-Za-z\\u00C0-\\u00FF]+`` of a slice, and their texts.  U+00C0 to U+00FF are C3 xx."""
    low = W.lower(s.data)
    lead = low == 0xC3
    inside = (low >= 0x61) & (low <= 0x7A) | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(low) + 1, bool)
    edge[s.bounds] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = end - start - (np.cumsum(np.append(0, lead))[end] - np.cumsum(np.append(0, lead))[start])
    start, end = start[size >= LEAST], end[size >= LEAST]
    return start, end, np.searchsorted(s.bounds, start, "right") - 1


def slip(doc: str, run: str, every: int = SLIP) -> str:
    """The run, less one code point if ``every`` divides the checksum of document and run."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    k = h % len(run)
    return run if h % every else run[:k] + run[k + 1:]


def _counted(batch: pa.RecordBatch, every: int):
    """``(word, n)`` of a batch of ``(doc_id, text)``: words of at least ``LEAST`` code points, counted by slice."""
    ids = [b"" if i is None else str(i).encode() for i in batch.column(0).to_pylist()]
    for s in W.slices(batch.column(1), 4 * W.SLICE):
        start, end, doc = _letter_runs(s)
        if not len(start):
            continue
        low = W.lower(s.data)
        h = W.span_hash(W.prefix_hash(low), start, end)
        order = np.lexsort((doc, h))
        h, doc, start, end = h[order], doc[order], start[order], end[order]
        both = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
        n = np.diff(np.append(both, len(h)))
        raw, seed = low.tobytes(), [zlib.crc32(ids[s.first + k] + b":") for k in range(len(s))]
        a, z, d = start[both].tolist(), end[both].tolist(), doc[both].tolist()
        sums = np.fromiter((zlib.crc32(raw[x:y], seed[k]) for x, y, k in zip(a, z, d)), np.int64, len(both))
        out = Counter()
        for j in np.flatnonzero(sums % every == 0).tolist():
            run = raw[a[j]:z[j]].decode()
            k = int(sums[j]) % len(run)
            if len(run) > LEAST:
                out[run[:k] + run[k + 1:]] += int(n[j])
        n[sums % every == 0] = 0
        first = np.flatnonzero(np.append(True, h[both][1:] != h[both][:-1]))
        total = np.add.reduceat(n, first)
        first, total = first[total > 0], total[total > 0]
        words = [raw[a[j]:z[j]].decode() for j in first.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([*words, *out]), pa.array([*total.tolist(), *out.values()], pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, least: int = TWICE, every: int = SLIP) -> DataFrame:
    """``(word, n)``: words of whole texts that occur at least ``least`` times."""
    counts = map_texts(documents(docs), lambda b: _counted(b, every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _entries(vocab: DataFrame) -> DataFrame:
    """Four rows a word: ``(len, back, key, list, n)``, where the list's words begin with its key."""
    size = F.length("word")
    kinds = F.array(*[F.struct((size - F.lit(d)).alias("len"), F.lit(back).alias("back")) for d in (0, 1) for back in (False, True)])
    e = vocab.select("word", "n", F.explode(kinds).alias("e")).select("word", "n", "e.*").where(F.col("len") >= LEAST)
    half = F.floor(F.col("len") / 2).cast("int")
    text = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    share = F.when(F.col("back"), F.col("len") - half).otherwise(half)
    return e.select("len", "back", text.substr(F.lit(1), share).alias("key"), text.alias("text"), "n")


def _dealt(vocab: DataFrame, n: int, block: int) -> DataFrame:
    """Entries by list, with the blocks that meet; ``role`` 1: the word reads, 2: it is read, 3: both.  Sorted."""
    e = _entries(vocab)
    by = ["len", "back", "key"]
    large = (e.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
             .select(*by, F.ceil(F.col("size") / F.lit(float(block))).cast("int").alias("blocks")))
    e = e.join(large, by, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    reads = F.transform(others, lambda j: F.struct(own.alias("i"), j.alias("j"), F.when(j == own, 3).otherwise(1).alias("role")))
    read = F.transform(F.filter(others, lambda i: i != own), lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(2).alias("role")))
    cells = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(3).alias("role")))).otherwise(F.concat(reads, read))
    rows = e.select(*by, "text", "n", F.explode(cells).alias("c")).select(*by, "text", "n", "c.*")
    return (rows.repartition(n, *by, "i", "j").sortWithinPartitions("len", "back", "i", "j", "text")
            .select("len", "back", "i", "j", F.col("text"), "n", "role"))


def _matrix(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of code points (all below 256), and their lengths."""
    size = pc.utf8_length(texts).to_numpy().astype(np.int64)
    raw = "".join(texts.to_pylist()).encode("latin-1")
    m = np.zeros((len(size), width), np.uint8)
    m[np.arange(width) < size[:, None]] = np.frombuffer(raw, np.uint8)
    return m, size


def _scan(words: np.ndarray, size: np.ndarray, group: np.ndarray, readers: np.ndarray, read: np.ndarray, share: int):
    """Pairs ``(reader, word)`` at exactly one edit.

    ``words`` are sorted inside each group (a run of equal ``group``); all of a group share their first ``share`` code
    points.  Only rows marked ``read`` are in the lists."""
    width = words.shape[1]
    listed = np.flatnonzero(read)
    lw, ls, lg = words[listed], size[listed], group[listed]
    m = len(listed)
    # LCP of a list's word with the one before it; -1 where a list begins
    lcp = np.full(m + 1, -1, np.int64)
    if m > 1:
        same = lw[1:] == lw[:-1]
        lcp[1:m] = np.where(same.all(1), width, same.argmin(1))
        lcp[1:m] = np.minimum(lcp[1:m], np.minimum(ls[1:], ls[:-1]))
        lcp[1:m][lg[1:] != lg[:-1]] = -1
    # leap[d, p]: the first word after p that shares fewer than d code points with p
    leap = np.empty((width + 2, m + 1), np.int32)
    places = np.arange(m + 1, dtype=np.int32)
    for d in range(width + 2):
        stop = np.where(lcp < d, places, m)
        leap[d, m] = m
        leap[d, :m] = np.minimum.accumulate(stop[::-1])[::-1][1:]
    begin = np.searchsorted(lg, group[readers], "left")
    begin[begin == m] = m
    go = (begin < m) & (begin < np.searchsorted(lg, group[readers], "right"))
    who, at = readers[go], begin[go]
    q = np.zeros((len(who), width + 3), np.uint8)
    q[:, 1:width + 1] = words[who]  # q[:, j + 1] is code point j
    a = size[who]
    depth = np.full(len(who), share)
    # rows[:, i]: cells j = i - 1, i, i + 1 of row i
    rows = np.full((len(who), width + 1, 3), _FAR, np.uint8)
    rows[:, share] = (1, 0, 1)
    out_reader, out_word = [], []
    live = np.arange(len(who))
    while len(live):
        p, i = at[live], depth[live]
        old = rows[live, i]
        over = i >= ls[p]  # the word ends here
        c = np.where(over, 0, lw[p, np.minimum(i, width - 1)])
        d0 = np.minimum(old[:, 1] + 1, old[:, 0] + (c != q[live, i]))
        d1 = np.minimum(np.minimum(old[:, 2] + 1, old[:, 1] + (c != q[live, i + 1])), d0 + 1)
        d2 = np.minimum(old[:, 2] + (c != q[live, i + 2]), d1 + 1)
        gap = a[live] - i
        end = np.where(gap == 0, old[:, 1], np.where(gap == -1, old[:, 0], np.where(gap == 1, old[:, 2], _FAR)))
        hit = over & (end == 1)
        out_reader.append(who[live[hit]])
        out_word.append(listed[p[hit]])
        dead = ~over & (np.minimum(np.minimum(d0, d1), d2) > 1)
        step = ~over & ~dead
        s = live[step]
        rows[s, i[step] + 1] = np.minimum(np.stack([d0[step], d1[step], d2[step]], 1), _FAR)
        depth[s] = i[step] + 1
        # to the next word: after a whole word the very next, else the first that leaves the prefix just read
        jump = ~step
        s = live[jump]
        nxt = np.where(over[jump], p[jump] + 1, leap[np.where(over[jump], 0, i[jump] + 1), p[jump]])
        at[s] = nxt
        depth[s] = np.minimum(depth[s], np.maximum(lcp[nxt], 0))
        stop = np.zeros(len(live), bool)
        stop[jump] = (nxt >= m) | (lcp[nxt] < share)
        live = live[~stop]
    return np.concatenate(out_reader) if out_reader else np.empty(0, np.int64), np.concatenate(out_word) if out_word else np.empty(0, np.int64)


def _met(length: int, back: bool, texts: pa.Array, count: np.ndarray, group: np.ndarray, role: np.ndarray) -> pa.RecordBatch | None:
    """Near words of a chunk of whole lists that share ``length`` and direction."""
    half = length // 2
    share = length - half if back else half
    words, size = _matrix(texts, length + 1)
    readers = np.flatnonzero((size == length) & (role & 1 > 0))
    if not len(readers):
        return None
    # lists of one block begin where the key changes
    new = np.ones(len(words), bool)
    new[1:] = (words[1:, :share] != words[:-1, :share]).any(1) | (group[1:] != group[:-1])
    u, v = _scan(words, size, np.cumsum(new), readers, role & 2 > 0, share)
    if back and len(u):  # pairs that share their first half too belong to the other direction
        k = np.arange(half)
        first = words[u[:, None], size[u][:, None] - 1 - k] == words[v[:, None], size[v][:, None] - 1 - k]
        u, v = u[~first.all(1)], v[~first.all(1)]
    longer = size[v] > length  # the shorter word reads for both
    u, v = np.concatenate([u, v[longer]]), np.concatenate([v, u[longer]])
    if not len(u):
        return None
    if back:  # the least word in code-point order, as words are written forwards
        spelled = np.array([t[::-1] for t in texts.take(pa.array(v)).to_pylist()])
    else:
        spelled = np.array(texts.take(pa.array(v)).to_pylist())
    order = np.lexsort((spelled, -count[v], u))
    u, v = u[order], v[order]
    first = np.flatnonzero(np.append(True, u[1:] != u[:-1]))

    def names(x):
        t = texts.take(pa.array(x))
        return pc.utf8_reverse(t) if back else t

    return pa.RecordBatch.from_arrays([names(u[first]), pa.array(np.diff(np.append(first, len(u)))), pa.array(count[v[first]]), names(v[first])],
                                      names=["word", "n_near", "best_n", "best"])


def _read_lists(batches):
    """``mapInArrow`` over sorted entries: whole lists are gathered into chunks of one length and direction."""
    held, rows = [], 0

    def done(part: pa.RecordBatch):
        length, back = part.column(0)[0].as_py(), part.column(1)[0].as_py()
        cell = part.column(2).to_numpy() * np.int64(1 << 31) + part.column(3).to_numpy()
        b = _met(length, back, part.column(4), part.column(5).to_numpy(), cell, part.column(6).to_numpy())
        return [] if b is None else [b]

    def cuts(t: pa.RecordBatch) -> np.ndarray:
        """Where a list or a block begins."""
        n = t.column(0).to_numpy()
        back = t.column(1).to_numpy(zero_copy_only=False)
        share = np.where(back, n - n // 2, n // 2)
        key = pc.utf8_slice_codeunits  # keys of one length at a time
        new = np.ones(len(n), bool)
        new[1:] = (n[1:] != n[:-1]) | (back[1:] != back[:-1]) | (t.column(2).to_numpy()[1:] != t.column(2).to_numpy()[:-1]) | (
            t.column(3).to_numpy()[1:] != t.column(3).to_numpy()[:-1])
        for s in np.unique(share):
            at = np.flatnonzero(share == s)
            k = key(t.column(4).take(pa.array(at)), 0, int(s))
            if len(at) > 1:
                diff = pc.not_equal(k.slice(1), k.slice(0, len(at) - 1)).to_numpy(zero_copy_only=False)
                new[at[1:]] |= diff & (at[1:] == at[:-1] + 1)
        return np.flatnonzero(new)

    def chunks(t: pa.RecordBatch, at: np.ndarray):
        """Lists of ``t`` joined into chunks that share length and direction and keep their tables small."""
        n, back = t.column(0).to_numpy(), t.column(1).to_numpy(zero_copy_only=False)
        ends = np.append(at[1:], t.num_rows)
        a = 0
        for k in range(len(at)):
            last = k + 1 == len(at)
            most = max(1, min(CHUNK, CELLS // (int(n[at[a]]) + 3)))
            if last or n[at[k + 1]] != n[at[a]] or back[at[k + 1]] != back[at[a]] or ends[k + 1] - at[a] > most:
                yield from done(t.slice(at[a], ends[k] - at[a]))
                a = k + 1

    def merged():
        t = pa.Table.from_batches(held).combine_chunks()
        return t.to_batches()[0]

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows >= CHUNK:
            t = merged()
            at = cuts(t)
            if len(at) > 1:  # the last list may go on in the next batch
                yield from chunks(t.slice(0, at[-1]), at[:-1])
                t = t.slice(at[-1])
            held, rows = [t], t.num_rows
    if held:
        t = merged()
        yield from chunks(t, cuts(t))


def neighbours(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(word, n_near, best_n, best)`` for every word that has near words; ``best`` has the largest count."""
    n = partitions(vocab.sparkSession)
    met = _dealt(vocab, n, block).mapInArrow(_read_lists, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def variants(docs: DataFrame, factor: int = FACTOR, least: int = TWICE, every: int = SLIP, block: int = BLOCK) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary."""
    path = Scratch(docs.sparkSession, "spelling")
    vocab = path.save(vocabulary(docs, least, every), "vocabulary")
    near = neighbours(vocab, block)
    has = F.col("best_n") >= F.lit(factor) * F.col("n")
    words = vocab.join(near, "word", "left").select(
        "word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n"))
    words = path.save(words, "words")
    links = words.where("form is not null").select("word", F.col("form").alias("to"))
    largest = vocab.agg(F.max("n")).first()[0] or 1
    chain = max(1, math.ceil(math.log(largest) / math.log(factor))) if factor > 1 else 64
    for k in range(math.ceil(math.log2(chain)) if chain > 1 else 0):  # links followed: 1, 2, 4, ...
        on = links.select(F.col("word").alias("to"), F.col("to").alias("next"))
        links = path.save(links.join(on, "to", "left").select("word", F.coalesce("next", "to").alias("to")), f"links-{k}")
    return words.join(links.withColumnRenamed("to", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
