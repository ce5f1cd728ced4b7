"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes: insult, threat, target, negation, reporting verb, other.  Small transducers follow the classes
of a clause (negation in scope, reported speech, a target nearby) and are composed into one machine by the product of
their states; on an insult or threat it writes out the pattern that was matched, such as "insult, targeted, not
negated, reported".  A text's score is a logistic function of the patterns of its clauses, not of isolated words.

The insult class starts from a fixed list and learns words and word beginnings that mark label 1, the pattern weights
are learned too, both on at most ``SAMPLE`` labelled rows (smallest hash of the id).  Copies of one text count little:
a marker must occur with several different MinHash values of the texts that hold it.

Defined cases: null and empty texts match nothing and get the score of that; ids that repeat in labels give several
training rows; null labels do not train; a null ``doc_id`` never trains; without labels of both kinds fixed weights
serve; an empty table gives an empty result; only ``doc_id``, ``text`` and ``toxic`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import Scratch, documents, map_texts

#: labelled rows that train at most
SAMPLE = 20_000
#: learned markers at most, least log-odds of one, byte lengths of word beginnings
MARKERS, ODDS, STEMS = 20_000, 3.5, (3, 4, 5, 6, 7, 8)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: fixed word lists (English, German, French, Spanish)
LISTS = {
    INSULT: "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown clowns imbecile "
            "dumb fool idiotisch dumm trottel abschaum widerlich wertlos imbécile stupide crétin ordure minable "
            "estúpido imbécil basura asqueroso inútil",
    THREAT: "kill kills murder hurt beat burn destroy shoot stab strangle töten umbringen schlagen verbrennen zerstören "
            "tuer frapper brûler détruire matar golpear quemar destruir",
    TARGET: "you your yours u he him she her they them those these people du dich dir ihr euch sie ihn tu te toi vous il elle "
            "ils elles ces gens tú ti usted ustedes él ella ellos ellas esa ese gente",
    NEGATION: "not no never neither nor without cannot nicht kein keine nie niemals ohne ne pas jamais sans aucun nunca "
              "ningún sin tampoco",
    REPORT: "said says say wrote writes quoted quotes called calls claimed claims reported according sagte sagt schrieb nannte "
            "zitierte laut dit écrit appelle cité selon dijo dice escribió llamó citó según",
}
#: bytes that end a clause
STOPS = b".!?;:,\n"
#: words that a negation or a target reaches
SCOPE = 5


# ---- transducers -----------------------------------------------------------------------------------------------
def within(cause: int, scope: int) -> dict[tuple[int, int], int]:
    """Machine with ``scope + 1`` states: ``cause`` is at most that many words back while the state is not 0."""
    return {(s, c): scope if c == cause else max(0, s - 1) for s in range(scope + 1) for c in range(6)}


def ever(cause: int) -> dict[tuple[int, int], int]:
    """Machine with two states: ``cause`` has been seen in this clause."""
    return {(s, c): 1 if c == cause else s for s in range(2) for c in range(6)}


def compose(*machines: dict[tuple[int, int], int]) -> tuple[list[list[int]], list[list[int]]]:
    """Product of the machines as tables ``next[state][class]`` and ``output[state][class]`` (-1: nothing).

    On an insult or threat the output is the number of the pattern: event, then one bit for each machine.
    """
    states, todo = {tuple(0 for _ in machines): 0}, [tuple(0 for _ in machines)]
    nxt, out = [], []
    while todo:
        s = todo.pop(0)
        row, write = [], []
        for c in range(6):
            t = tuple(m[x, c] for m, x in zip(machines, s, strict=True))
            if t not in states:
                states[t] = len(states)
                todo.append(t)
            row.append(states[t])
            bits = sum(1 << i for i, x in enumerate(t) if x)
            write.append((0 if c == INSULT else 1 << len(machines)) + bits if c in (INSULT, THREAT) else -1)
        nxt.append(row)
        out.append(write)
    return nxt, out


_NEXT, _OUT = compose(within(NEGATION, SCOPE), ever(REPORT), within(TARGET, SCOPE))
_BACK = within(TARGET, SCOPE)
#: event (insult, threat) x target x report x negation
PATTERNS = 16


def clause_patterns(classes: list[int]) -> list[int]:
    """Patterns that the composed machine matches in one clause; a target may also follow its event."""
    after, s = [], 0
    for c in reversed(classes):
        s = _BACK[s, c]
        after.append(s > 0)
    after.reverse()
    found, s = [], 0
    for c, target in zip(classes, after, strict=True):
        if _OUT[s][c] >= 0:
            found.append(_OUT[s][c] | (4 if target else 0))
        s = _NEXT[s][c]
    return found


# ---- word classes ----------------------------------------------------------------------------------------------
_WHOLE = W.U64(0x3C6EF372FE94F82A)


def _markers(w: W.Words, prefix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, hashes) of whole words and of their beginnings."""
    yield np.arange(len(w.start)), w.hash ^ _WHOLE
    size = w.end - w.start
    for n in STEMS:
        at = np.flatnonzero(size > n)
        yield at, W.span_hash(prefix, w.start[at], w.start[at] + n)


def _fixed() -> dict[int, int]:
    out = {}
    for kind, text in LISTS.items():
        for word in text.split():
            b = np.frombuffer(word.encode(), np.uint8)
            out[int(W.words(W.Slice(0, b, np.array([0, len(b)])), W.ALNUM).hash[0] ^ _WHOLE)] = kind
    return out


class Lexicon:
    """Sorted hashes with their class; learned markers are insults."""

    def __init__(self, learned: list[int]):
        table = {int(np.array([x], np.int64).view(W.U64)[0]): INSULT for x in learned} | _fixed()
        self.keys = np.array(sorted(table), W.U64)
        self.kind = np.array([table[int(k)] for k in self.keys], np.int8)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.keys & W.U64((1 << 22) - 1)] = True

    def classes(self, w: W.Words, prefix: np.ndarray) -> np.ndarray:
        out = np.zeros(len(w.start), np.int8)
        for at, h in _markers(w, prefix):
            hit = np.flatnonzero(self.bits[h & W.U64((1 << 22) - 1)])
            i = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
            ok = self.keys[i] == h[hit]
            word, kind = at[hit[ok]], self.kind[i[ok]]
            out[word] = np.where(out[word] == OTHER, kind, out[word])  # a whole word's class goes first
        return out


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def pattern_counts(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Counts of all patterns for each text."""
    out = np.zeros((len(texts), PATTERNS))
    stop = np.isin(np.arange(256), list(STOPS))
    for s in W.slices(_lower(texts)):
        w = W.words(s, W.ALNUM)
        kinds = lexicon.classes(w, W.prefix_hash(w.low))
        events = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
        if not len(events):
            continue
        doc = w.doc()
        clause = np.cumsum(stop[w.low])[w.start] if len(w.start) else w.start
        cut = np.flatnonzero(np.concatenate([[True], (clause[1:] != clause[:-1]) | (doc[1:] != doc[:-1])]))
        for c in np.unique(np.searchsorted(cut, events, "right") - 1).tolist():
            a, z = int(cut[c]), int(cut[c + 1]) if c + 1 < len(cut) else len(kinds)
            for pattern in clause_patterns(kinds[a:z].tolist()):
                out[s.first + int(doc[a]), pattern] += 1
    return out


# ---- learning --------------------------------------------------------------------------------------------------
def _evidence(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Per marker: texts of label 0, and for label 1 one row for each MinHash value of the texts."""
    toxic = b.column("toxic").to_numpy()
    clean, marks, units = [], [], []
    for s in W.slices(_lower(b.column("text"))):
        w = W.words(s, W.ALNUM)
        if not len(w.start):
            continue
        doc = w.doc()
        unit = np.zeros(len(s), W.U64)
        full = np.diff(w.first) > 0
        unit[full] = np.minimum.reduceat(W.mix(w.hash), w.first[:-1][full])
        pairs = [(doc[at], h) for at, h in _markers(w, W.prefix_hash(w.low))]
        d, h = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        _, first = np.unique(W.mix(h + W.mix(d.astype(W.U64))), return_index=True)
        d, h = d[first], h[first]
        bad = toxic[s.first + d] == 1
        clean.append(h[~bad])
        marks.append(h[bad])
        units.append(unit[d[bad]])
    if not clean:
        return
    k, c = np.unique(np.concatenate(clean), return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(W.signed(k)), pa.nulls(len(k), pa.int64()), pa.array(c.astype(np.int64))],
                                     ["mark", "unit", "clean"])
    m, u = np.concatenate(marks), np.concatenate(units)
    yield pa.RecordBatch.from_arrays([pa.array(W.signed(m)), pa.array(W.signed(u)), pa.array(np.zeros(len(m), np.int64))],
                                     ["mark", "unit", "clean"])


def training_rows(docs: DataFrame, labels: DataFrame, held: Column) -> DataFrame:
    """``text, toxic`` of at most ``SAMPLE`` labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held)
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    return documents(docs).join(F.broadcast(known), "doc_id").select("text", "toxic")  # at most SAMPLE rows


def learn_markers(rows: DataFrame, n_toxic: int, n_clean: int) -> list[int]:
    """Hashes of words and beginnings that mark label 1: log-odds of at least ``ODDS``, and enough different texts."""
    if not n_toxic or not n_clean:
        return []
    seen = map_texts(rows, _evidence, "mark long, unit long, clean long").groupBy("mark", "unit").agg(F.sum("clean").alias("clean"))
    per = seen.groupBy("mark").agg(F.count("unit").alias("texts"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("texts") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    least = max(5, n_toxic // 100)
    found = per.where((F.col("texts") >= least) & (odds >= ODDS)).orderBy(F.desc("texts"), "mark").limit(MARKERS)
    return [r.mark for r in found.select("mark").collect()]


def features(counts: np.ndarray) -> np.ndarray:
    """Constant, all events, and every pattern, on a log scale."""
    return np.hstack([np.ones((len(counts), 1)), np.log1p(counts.sum(axis=1, keepdims=True)), np.log1p(counts)])


#: weights without training: an event weighs 4, less when it is negated or reported, more with a target
DEFAULT = np.array([-3.0, 4.0, *[-1.5 * (k & 1) - 1.0 * (k >> 1 & 1) + 0.5 * (k >> 2 & 1) for k in range(PATTERNS)]])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, with a small pull towards the default weights."""
    if not len(y) or y.min() == y.max():
        return DEFAULT
    w, pull = DEFAULT.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + pull * (w - DEFAULT)
        hess = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, texts: pa.Array) -> np.ndarray:
        z = features(pattern_counts(texts, self.lexicon)) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, held: Column) -> Model:
    """Markers first, then pattern weights, both from the bounded sample (a written table)."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = scratch.save(training_rows(docs, labels, held), "sample")
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    lexicon = Lexicon(learn_markers(rows, n.get(1, 0), n.get(0, 0)))
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most MARKERS hashes and the fixed lists

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = pattern_counts(b.column("text"), sent.value)
        yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(list(counts), pa.list_(pa.float64()))], ["toxic", "counts"])

    # at most SAMPLE rows come to the driver
    seen = map_texts(rows, work, "toxic int, counts array<double>").collect()
    weights = fit(features(np.array([r.counts for r in seen]).reshape(-1, PATTERNS)), np.array([r.toxic for r in seen], float))
    scratch.drop("sample")
    return Model(lexicon, weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text, score`` (0 to 1) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(sent.value.score(b.column("text")))],
                                         ["doc_id", "text", "score"])

    return map_texts(documents(docs), work, "doc_id long, text string, score double")


def keep(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text scores less than ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield b.filter(pa.array(sent.value.score(b.column("text")) < threshold))

    return map_texts(docs, work, docs.schema)


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))
