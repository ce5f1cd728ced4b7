"""Katz backoff scores: Good-Turing discounted counts with exactly normalised backoff weights.

Order 2: P(w | h) is the discounted relative frequency of (h, w) when training text has it, else alpha(h) P(w), and
P(w) is the discounted relative frequency of w, or an equal share of the rest for a word that training text lacks
(Chao's estimate says how many such words there are).  After a word that training text lacks the model uses P(w).
With ``every``, all words of the training text and the start of a text are histories; their counts and alphas are a
table partitioned by history.  Without it only listed words are: those with at least ``1 / HISTORIES`` of all training
tokens (and two of them), at most ``HISTORIES`` whatever the corpus, so their table may go to every task.

Tokens are dealt by word, compactly: a partition holds all tokens of its words, counts them, and scores them where
they are counted.  Listed words are dealt by (word, history), or by a history that is not listed alone, which is rare
and so written once for all tokens after it; pairs with at least ``1 / HOT_PAIRS`` of
all tokens are counted beforehand and scored in place, so no partition gets a fixed share of all tokens.
Good-Turing discounts and alphas need counts of all partitions, so a partition returns, for each document, how many of
its tokens have which small count and which histories back off, and for each history the sums that its alpha needs.
Documents travel in groups (those that a task dealt together), so what comes back is one packed row for each group and
partition, not one for each document; a group's rows then meet and are added up.  A group is named by its documents, so
``docs`` must come in the same order when a task runs again, as files do; a group that lacks rows fails the query.
What a score takes from its history's count is added where that word's own count is known: with the word before.
Histories that back off are joined with the table of alphas (listed ones in the task).

Defined cases: a null or empty text is the end token alone; rows that are equal are scored once and counted each;
a null ``doc_id`` is not held out; an empty table gives an empty result; without training text every word has the
same probability; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import Scratch, documents, map_texts, partitions, salted_join

HISTORIES = 65_000
HOT_PAIRS = 4096
#: counts up to this are discounted
K = 5
#: tokens that a task deals out at a time
FLUSH = 1_000_000
#: training tokens of a partition, about
PART = 1_500_000
#: tokens that are scored at a time
STEP = 200_000
END = W.U64(0xE4D0F7E47E7EE4D1)
#: number of the start-of-text history; 0 is none (or not listed), words follow from 2
START = 1
#: hash of the start-of-text history
BEGIN = W.U64(0x51A27B0C9D3E6F15)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def _tokens(s: W.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the slice (each text's words, then the end) and the bounds of each text's part."""
    w = W.words(s, W.NOT_SPACE)
    n = len(s)
    h = np.empty(len(w.hash) + n, W.U64)
    bounds = w.first + np.arange(n + 1)
    is_end = np.zeros(len(h), bool)
    is_end[bounds[1:] - 1] = True
    h[is_end] = END
    h[~is_end] = w.hash
    return h, bounds


class _Index:
    """Positions of hashes in a sorted table, behind a bit table."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << 20, bool)
        self.bits[keys & W.U64((1 << 20) - 1)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 for none."""
        out = np.full(len(h), -1, np.int64)
        at = np.flatnonzero(self.bits[h & W.U64((1 << 20) - 1)])
        if len(self.keys) and len(at):
            i = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            ok = self.keys[i] == h[at]
            out[at[ok]] = i[ok]
        return out


def _counts(keys: Iterator[np.ndarray], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Counts of the keys, at most ``FLUSH`` at a time."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        k, c = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c.astype(np.int64))], list(names))

    for k in keys:
        held.append(k)
        size += len(k)
        if size >= FLUSH:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def unigrams(train: DataFrame) -> DataFrame:
    """``tok, c`` of training texts."""

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield from _counts((_tokens(s)[0] for s in W.slices(b.column("text"))), ("tok", "c"))

    return map_texts(train, work, "tok long, c long").groupBy("tok").agg(F.sum("c").alias("c"))


def _history(h: np.ndarray, bounds: np.ndarray, index: _Index) -> np.ndarray:
    """Number of each token's history: that of the word before it, ``START`` for the first one, 0 for one not listed."""
    own = index.find(h) + 2
    own[own == 1] = 0
    out = np.empty(len(h), np.int64)
    out[1:] = own[:-1]
    out[bounds[:-1]] = START
    return out


def discounts(n: dict[int, int]) -> list[float]:
    """Good-Turing d_1..d_K by counts of counts (Katz); where these are no discounts, half a count is taken off."""
    common = (K + 1) * n.get(K + 1, 0) / n[1] if n.get(1) else 0.0
    out = []
    for r in range(1, K + 1):
        d = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - common) / (1 - common) if n.get(r) and common < 1 else 0.0
        out.append(d if 0.02 < d < 1 else 1 - 0.5 / r)
    return out


class Model:
    """What every task needs: totals, the unigram discounts, the listed words and the hot pairs (all bounded)."""

    def __init__(self, total: int, kinds: int, n: dict[int, int], words: np.ndarray, counts: np.ndarray, starts: int,
                 every: bool):
        self.total, self.kinds, self.d, self.every = total, kinds, discounts(n), every
        self.index = _Index(words)
        self.count = np.concatenate([[0, starts], counts]).astype(np.int64)  # by history number
        self.names = np.concatenate([np.array([0, BEGIN], W.U64), words])  # hashes by history number
        kept = total - sum(r * n.get(r, 0) * (1 - self.d[r - 1]) for r in range(1, K + 1))
        unseen = max(1.0, n.get(1, 0) ** 2 / (2 * max(1, n.get(2, 0))))
        self.zero = math.log10((1 - kept / total) / unseen) if total and kept < total else -math.log10(unseen + kinds)
        self.hot_pairs, self.hot_counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def log_p(self, c: np.ndarray) -> np.ndarray:
        """log10 P(w) for words of these training counts."""
        out = np.full(len(c), self.zero)
        seen = c > 0
        d = np.concatenate([[1.0], self.d, [1.0]])[np.minimum(c[seen], K + 1)]
        out[seen] = np.log10(d * c[seen] / max(self.total, 1))
        return out

    def log_history(self, c: np.ndarray) -> np.ndarray:
        """log10 of what a history of this count makes of a pair's count; half a count of every history is kept back,
        so that a history whose pairs are all frequent leaves something to the words that never followed it."""
        return np.log10((1 - 0.5 / c) / c)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + 1 * (self.kinds + 1)))


def _pair(word: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Number of a pair of listed words; no word or no history gives -1."""
    return np.where((word >= 0) & (history > 0), word * 65536 + history, -1)


def hot_pairs(train: DataFrame, model: Model) -> DataFrame:
    """``pair, c`` of the pairs whose word and history are both listed."""

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[np.ndarray]:
            for s in W.slices(b.column("text")):
                h, bounds = _tokens(s)
                pair = _pair(model.index.find(h), _history(h, bounds, model.index))
                yield pair[pair >= 0]

        yield from _counts(pairs(), ("pair", "c"))

    return map_texts(train, work, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))


_CTX = "history long, mass long, prob double, " + ", ".join(f"t{r} long" for r in range(1, K + 2))
_CTX_NAMES = [x.split()[0] for x in _CTX.split(", ")]
_OUT = f"source long, blob binary, {_CTX}"
_PART = "part int, place int, source long, blob binary"


class _Sums:
    """Per-document sums of token scores."""

    def __init__(self, n: int):
        self.known, self.base, self.raw = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        self.small = np.zeros((K, n), np.int64)

    def add(self, doc: np.ndarray, c: np.ndarray, pair: np.ndarray, history: np.ndarray, leads: np.ndarray,
            model: Model) -> np.ndarray:
        """Adds tokens with word counts ``c`` and pair counts ``pair``; ``history``: which have one; ``leads``: which are
        a history themselves, of the token after them.  Returns which back off from a history."""
        n = len(self.base)
        self.known += np.bincount(doc[c > 0], minlength=n)
        self.base += np.bincount(doc, model.base(c), n)
        seen = history & (pair > 0)
        score = model.log_p(c)
        score[seen] = np.log10(pair[seen])
        score[leads] += model.log_history(c[leads])
        self.raw += np.bincount(doc, score, n)
        for r in range(1, K + 1):
            self.small[r - 1] += np.bincount(doc[seen & (pair == r)], minlength=n)
        return history & ~seen

    def columns(self, at: slice = slice(None)) -> list[np.ndarray]:
        return [self.known[at], self.base[at], self.raw[at], self.small[:, at].ravel()]


#: tokens by text of a group: places and held-out marks of the texts; tokens by word (words, their numbers of tokens, listed
#: histories, places of the texts, histories that are not listed); tokens by history (histories, their numbers of tokens,
#: listed words, places of the texts)
_DEALT = (np.uint16, np.uint8, W.U64, np.uint32, np.uint16, np.uint16, W.U64, W.U64, np.uint32, np.uint16, np.uint16)
#: sums by text: places of the texts; keys, numbers of tokens and the number of rows dealt (once a group); the sums; the
#: histories to back off from, listed and not, and how many each text has of both
_SUMS = (np.uint16, np.int64, np.uint32, np.int64, np.uint32, np.float64, np.float64, np.uint32, np.uint32, np.uint16, np.uint32, W.U64)
#: the same with discounts and listed alphas in the score
_DONE = (np.uint16, np.int64, np.uint32, np.int64, np.uint32, np.float64, np.float64)


def _pack(kinds: tuple, *cols: np.ndarray) -> bytes:
    raw = b"".join(x.astype(k, copy=False).tobytes() for x, k in zip(cols, kinds, strict=True))
    return np.array([len(raw), *map(len, cols)], np.int64).tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpack(kinds: tuple, blob: pa.Buffer) -> list[np.ndarray]:
    head = np.frombuffer(blob, np.int64, len(kinds) + 1).tolist()
    raw = pa.Codec("zstd").decompress(blob.slice(8 * len(head)), head[0])
    out, at = [], 0
    for kind, n in zip(kinds, head[1:], strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def _by_text(doc: np.ndarray, values: np.ndarray, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
    """How many values each of the texts ``[a, z)`` has, and the values in their order; ``doc`` is sorted."""
    at = np.searchsorted(doc, np.arange(a, z + 1))
    return np.diff(at), values[at[0] : at[-1]]


def _packed_rows(source: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    cols = [pa.array(source, pa.int64()), pa.array(blobs, pa.binary())]
    types = [pa.int64(), pa.int64(), pa.float64()] + [pa.int64()] * (K + 1)
    return pa.RecordBatch.from_arrays(cols + [pa.nulls(len(blobs), t) for t in types], ["source", "blob", *_CTX_NAMES])


#: texts of a batch that are looked at together, however wide the batch is
AT_ONCE = 16_000

def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the runs of ``x`` and their lengths."""
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]))
    return x[new], np.diff(np.append(new, len(x)))


def _deal(batches: Iterator[pa.RecordBatch], model: Model, parts: int) -> Iterator[pa.RecordBatch]:
    """Deals tokens to partitions; part -1 rows carry the scores of hot pairs and the token numbers."""
    hot = model.hot_pairs
    held: list[tuple] = []
    size = docs = 0

    def rows_of(source: int, rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([source] * len(rows), pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["part", "place", "source", "blob"])

    def flush() -> Iterator[pa.RecordBatch]:
        key, out, doc, h, hist = (np.concatenate([x[k] for x in held]) for k in range(5))
        held.clear()
        prev = np.concatenate([h[:1], h[:-1]])
        word = model.index.find(h).astype(np.int32)
        number = _pair(word.astype(np.int64), hist.astype(np.int64))
        pair = np.minimum(np.searchsorted(hot, number), max(len(hot) - 1, 0))
        place = (hot[pair] == number) if len(hot) else np.zeros(len(h), bool)
        sums = _Sums(len(key))
        sums.add(doc[place], model.count[word[place] + 2], model.hot_counts[pair[place]], hist[place] > 0, h[place] != END, model)
        del number, pair
        tokens = np.bincount(doc, minlength=len(key))
        if model.count[START]:
            sums.raw += model.log_history(model.count[START])
        source = int.from_bytes(hashlib.blake2b(key.tobytes(), digest_size=8).digest(), "little", signed=True)
        rest = ~place
        doc, h, hist, prev, word = doc[rest], h[rest], hist[rest], prev[rest], word[rest]
        rare = (hist == 0) & model.every
        after = rare & (word >= 0)  # dealt by history
        lead = np.where(after, prev, h)
        del h, place, rest
        deal = (W.mix(lead + np.where((word >= 0) & ~after, hist.astype(W.U64), W.U64(0))) % W.U64(parts)).astype(np.int32)
        order = np.lexsort((lead, after, deal))
        cols = [doc, lead, hist, prev, word, rare, after, deal]
        del doc, lead, hist, prev, word, rare, after, deal
        for k, x in enumerate(cols):  # one at a time: a task's memory holds few copies
            cols[k] = x[order]
        doc, lead, hist, prev, word, rare, after, deal = cols
        cut = np.searchsorted(deal, np.arange(parts + 1))
        dealt = len(np.unique(deal))
        none = np.empty(0, np.int64)
        rows = [(source % parts, 1, _pack(_SUMS, np.arange(len(key)), key, tokens, np.array([dealt]), *sums.columns(), *[none] * 4))]
        for p in range(parts):
            a, z = int(cut[p]), int(cut[p + 1])
            if a == z:
                continue
            mine, back = np.unique(doc[a:z], return_inverse=True)
            m = a + int(np.searchsorted(after[a:z], True))
            rows.append((p, 0, _pack(_DEALT, mine, out[mine], *_groups(lead[a:m]), hist[a:m], back[: m - a], prev[a:m][rare[a:m]],
                                     *_groups(lead[m:z]), word[m:z] + 2, back[m - a :])))
            if len(rows) == 16:
                yield rows_of(source, rows)
                rows = []
        if rows:
            yield rows_of(source, rows)

    for b in (b.slice(k, AT_ONCE) for b in batches for k in range(0, b.num_rows, AT_ONCE)):
        keys, outs = b.column("key").to_numpy(), b.column("held").to_numpy(zero_copy_only=False)
        for s in W.slices(b.column("text")):
            h, bounds = _tokens(s)
            doc = np.repeat(np.arange(docs, docs + len(s), dtype=np.uint16), np.diff(bounds))
            held.append((keys[s.first : s.first + len(s)], outs[s.first : s.first + len(s)], doc, h,
                         _history(h, bounds, model.index).astype(np.uint16)))
            size, docs = size + len(h), docs + len(s)
            if size >= FLUSH or docs >= (1 << 16) - AT_ONCE:  # documents have 16-bit numbers
                yield from flush()
                size = docs = 0
    if held:
        yield from flush()


def _score_part(sources: list[int], blobs: list[pa.Buffer], model: Model) -> Iterator[pa.RecordBatch]:
    """Counts and scores all tokens of one partition."""
    got = [_unpack(_DEALT, x) for x in blobs]
    first = np.cumsum([0] + [len(g[0]) for g in got])

    def column(k: int) -> np.ndarray:
        return np.concatenate([g[k] for g in got])

    mine, out = column(0), column(1) > 0
    word, lead, history = column(2), column(7), column(4).astype(np.int32)
    doc = np.concatenate([g[k] + np.int32(first[i]) for k in (5, 10) for i, g in enumerate(got)])
    if model.every:  # histories that are not listed get numbers of this partition
        rare, number = np.unique(np.concatenate([column(6), lead]), return_inverse=True)
        number = (len(model.names) + number).astype(np.int32)
        n = len(number) - len(lead)
        history[history == 0] = number[:n]
        history = np.concatenate([history, np.repeat(number[n:], column(8))])
        names = np.concatenate([model.names, rare])
        del rare, number
    else:
        names = model.names
    listed = column(9)  # words of the tokens dealt by history
    kinds = np.unique(np.concatenate([word, model.names[np.unique(listed)]]))
    kind = np.concatenate([np.repeat(np.searchsorted(kinds, word).astype(np.int32), column(3)),
                           np.searchsorted(kinds, model.names).astype(np.int32)[listed]])
    del got, word, lead, listed
    train = ~out[doc]
    c = np.bincount(kind[train], minlength=len(kinds))
    listed = model.index.find(kinds)
    c[listed >= 0] = model.count[listed[listed >= 0] + 2]  # these words are dealt over several partitions
    leads = (kinds != END) & (c > 0) & ((listed >= 0) | model.every)
    pairs, pair = np.unique(kind.astype(np.int64) * len(names) + history, return_inverse=True)
    pair = pair.astype(np.int32)
    n = np.bincount(pair[train], minlength=len(pairs))
    sums = _Sums(len(mine))
    back = np.zeros(len(doc), bool)
    for a in range(0, len(doc), STEP):
        at = slice(a, a + STEP)
        back[at] = sums.add(doc[at], c[kind[at]], n[pair[at]], history[at] > 0, leads[kind[at]], model)
    back = np.flatnonzero(back)
    back = back[np.argsort(doc[back], kind="stable")]
    text, off, few = doc[back], history[back], history[back] < len(model.names)
    none, packed = np.empty(0, np.int64), []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        packed.append(_pack(_SUMS, mine[a:z], none, none, none, *sums.columns(slice(a, z)), *_by_text(text[few], off[few], a, z),
                            *_by_text(text[~few], names[off[~few]], a, z)))
    yield _packed_rows(sources, packed)
    seen = (n > 0) & (pairs % len(names) > 0)
    h, n, p = pairs[seen] % len(names), n[seen], 10 ** model.log_p(c[pairs[seen] // len(names)])
    yield _history_rows(names, h, n, p)


def _history_rows(names: np.ndarray, h: np.ndarray, n: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    """Sums by history of pairs with history numbers ``h``, counts ``n`` and word probabilities ``p``."""
    hs, at = np.unique(h, return_inverse=True)
    cols = [pa.array(W.signed(names[hs])), pa.array(np.bincount(at, np.where(n > K, n, 0), len(hs)).astype(np.int64)),
            pa.array(np.bincount(at, p, len(hs)))]
    cols += [pa.array(np.bincount(at[n == r], minlength=len(hs)).astype(np.int64)) for r in range(1, K + 2)]
    return pa.RecordBatch.from_arrays([pa.nulls(len(hs), pa.int64()), pa.nulls(len(hs), pa.binary()), *cols], ["source", "blob", *_CTX_NAMES])


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    now, sources, blobs = None, [], []
    for b in batches:
        cells = (x.as_buffer() for x in b.column("blob"))  # views of the batch, not copies
        for part, place, source, blob in zip(b.column("part").to_pylist(), b.column("place").to_pylist(),
                                             b.column("source").to_pylist(), cells, strict=True):
            if place:
                yield _packed_rows([source], [blob.to_pybytes()])
                continue
            if part != now and blobs:
                yield from _score_part(sources, blobs, model)
                sources, blobs = [], []
            now = part
            sources.append(source)
            blobs.append(blob)
    if blobs:
        yield from _score_part(sources, blobs, model)


def histories(out: DataFrame, model: Model, scratch: Scratch) -> tuple[DataFrame, list[float]]:
    """``history, c, log_alpha, back`` by history, and the pair discounts, from the sums of all partitions and the hot
    pairs; ``back`` is what a token that backs off adds, besides what the word before it has added already."""
    hot = _history_rows(model.names, model.hot_pairs % 65536, model.hot_counts,
                        10 ** model.log_p(model.count[model.hot_pairs // 65536 + 2]))
    spark = out.sparkSession
    rows = out.where("history is not null").select(*_CTX_NAMES).unionByName(
        spark.createDataFrame([tuple(r[c] for c in _CTX_NAMES) for r in hot.to_pylist()], _CTX))  # at most HOT_PAIRS rows
    sums = scratch.save(rows.groupBy("history").agg(*[F.sum(c).alias(c) for c in _CTX_NAMES[1:]]), "contexts")
    few = sums.agg(*[F.coalesce(F.sum(f"t{r}"), F.lit(0)).alias(f"t{r}") for r in range(1, K + 2)]).first()
    d = discounts({r: few[f"t{r}"] for r in range(1, K + 2)})
    c, kept = F.col("mass"), F.col("mass").cast("double")
    for r in range(1, K + 1):
        c, kept = c + r * F.col(f"t{r}"), kept + d[r - 1] * r * F.col(f"t{r}")
    own = (1 - 0.5 / F.col("c")) / F.col("c")
    least = F.lit(1e-12)
    alpha = F.log10(F.greatest(1 - F.col("kept") * own, least) / F.greatest(1 - F.col("prob"), least))
    table = sums.select("history", "prob", c.alias("c"), kept.alias("kept")).select("history", "c", alpha.alias("log_alpha"))
    table = table.withColumn("back", F.col("log_alpha") - F.log10(own))
    table = table.repartition(max(1, partitions(spark)), "history").sortWithinPartitions("history")
    table = scratch.save(table, "histories")
    scratch.drop("contexts")
    return table, d


def _uid(source: int, doc: np.ndarray) -> np.ndarray:
    """Number of a text of a group."""
    return W.signed(W.mix(np.array([source], np.int64).view(W.U64) + W.mix(doc.astype(W.U64))))


def _finish(b: pa.RecordBatch, back: np.ndarray, d: list[float]) -> Iterator[pa.RecordBatch]:
    """Adds the discounts and the backoff weights of listed histories to a partition's sums."""
    blobs = []
    for x in b.column("blob"):
        doc, key, tokens, dealt, known, base, raw, small, listed, number, _, _ = _unpack(_SUMS, x.as_buffer())
        score = raw + np.log10(d) @ small.reshape(K, len(doc))
        if len(number):
            score += np.bincount(np.repeat(np.arange(len(doc)), listed), back[number], len(doc))
        blobs.append(_pack(_DONE, doc, key, tokens, dealt, known, base, score))
    yield pa.RecordBatch.from_arrays([b.column("source"), pa.array(blobs, pa.binary())], ["source", "blob"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up each group's rows; they come sorted by group."""

    def group(source: int, got: list[list[np.ndarray]]) -> pa.RecordBatch:
        whole = [g for g in got if len(g[3])]
        if len(got) != sum(1 + int(g[3][0]) for g in whole):  # equal groups have one name: all of their rows are here
            raise ValueError("texts came in another order when a task ran again: write them to a table first")
        n = len(whole[0][1])
        known, base, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for g in got:  # a text has one place in each of them
            known[g[0]] += g[4]
            base[g[0]] += g[5]
            score[g[0]] += g[6]
        tokens = np.sum([g[2].astype(np.int64) for g in whole], axis=0)
        cols = [_uid(source, np.arange(n)), whole[0][1], np.full(n, len(whole), np.int64), tokens, known, base, score]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["uid", "key", "rows", "n_tokens", "n_known", "base", "score"])

    now, got = None, []
    for b in batches:
        for source, blob in zip(b.column("source").to_pylist(), b.column("blob"), strict=True):
            if source != now and got:
                yield group(now, got)
                got = []
            now = source
            got.append(_unpack(_DONE, blob.as_buffer()))
    if got:
        yield group(now, got)


def _rest(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``uid, history`` of the tokens that back off from a history that is not listed."""
    for source, x in zip(b.column("source").to_pylist(), b.column("blob"), strict=True):
        got = _unpack(_SUMS, x.as_buffer())
        if len(got[11]):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(_uid(source, got[0]), got[10])), pa.array(W.signed(got[11]))], ["uid", "history"])


def train(docs: DataFrame, scratch: Scratch, every: bool = False) -> Model:
    """Counts words (a written table, sorted by word) and frequent pairs of ``docs``."""
    n = max(1, partitions(docs.sparkSession))
    words = scratch.save(unigrams(docs).repartition(n, "tok").sortWithinPartitions("tok"), "unigrams")
    total, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    few = {r.c: r.n for r in words.where(F.col("c") <= K + 1).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    often = words.where(F.col("c") * HISTORIES >= max(total, 2 * HISTORIES)).collect()  # at most HISTORIES rows
    often.sort(key=lambda r: r.tok % (1 << 64))
    starts = words.where(F.col("tok") == int(np.array([END]).view(np.int64)[0])).first()
    model = Model(total, kinds, few, np.array([r.tok for r in often], np.int64).view(W.U64),
                  np.array([r.c for r in often], np.int64), starts.c if starts else 0, every)
    pairs = hot_pairs(docs, model).where(F.col("c") * HOT_PAIRS >= max(total, 1)).collect()  # at most HOT_PAIRS rows
    pairs.sort(key=lambda r: r.pair)
    model.hot_pairs = np.array([r.pair for r in pairs], np.int64)
    model.hot_counts = np.array([r.c for r in pairs], np.int64)
    return model


def score(docs: DataFrame, held: Column, every: bool = False) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row; ``held`` rows do not train.

    ``every``: all words of the training text are histories, not just listed ones."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "katz")
    rows = documents(docs).withColumn("held", held).withColumn("key", F.xxhash64("doc_id", "text"))
    model = train(rows.where(~F.col("held")).select("text"), scratch, every)
    sent = spark.sparkContext.broadcast(model)  # at most HISTORIES words and HOT_PAIRS pairs
    n = max(1, partitions(spark))
    parts = max(1, -(-model.total // PART))
    dealt = rows.select("key", "held", "text").mapInArrow(lambda bs: _deal(bs, sent.value, parts), _PART)
    dealt = dealt.repartitionById(parts, "part").sortWithinPartitions("part", "place")  # one part a task
    out = scratch.save(dealt.mapInArrow(lambda bs: _score(bs, sent.value), _OUT), "sums")
    table, d = histories(out, model, scratch)
    begin = int(BEGIN.view(np.int64))
    often = table.where((F.col("c") * HISTORIES >= model.total) | (F.col("history") == begin)).collect()  # at most HISTORIES + 1 rows
    weight = {r.history: r.back for r in often}
    sent_back = spark.sparkContext.broadcast(np.array([weight.get(x, 0.0) for x in W.signed(model.names).tolist()]))
    packed = out.where("source is not null").select("source", "blob")
    done = map_texts(packed, lambda b: _finish(b, sent_back.value, d), "source long, blob binary")
    done = done.repartition(n, "source").sortWithinPartitions("source").mapInArrow(
        _gather, "uid long, key long, rows long, n_tokens long, n_known long, base double, score double")
    rest = map_texts(packed, _rest, "uid long, history long").join(table.select("history", "back"), "history")
    rest = rest.groupBy("uid").agg(F.sum("back").alias("score"))
    sums = ("rows", "n_tokens", "n_known", "base", "score")
    # groups of equal documents share their uids: their sums are multiples of one group's
    done = done.groupBy("uid", "key").agg(*[F.sum(c).alias(c) for c in sums]).join(rest.withColumnRenamed("score", "more"), "uid", "left")
    done = done.withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0)))
    # and so are those of equal rows
    one = done.groupBy("key").agg(*[F.sum(c).alias(c) for c in sums]).select(
        "key", (F.col("n_tokens") / F.col("rows")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("rows")).cast("long").alias("n_known"),
        (F.col("base") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score"))
    ids = rows.select("doc_id", "held", "key")
    return salted_join(ids, one, ["key"], "doc_id").select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score")
