"""SpotSigs document fingerprints.

A spot signature is a chain of content words after a common word (the anchor): in "the quick brown fox" the anchor
"the" gives "the:quick:brown".  A text's fingerprint is the set of its signatures, written as sorted 32-bit hashes in
base64.  Documents are compared by the Jaccard similarity of these sets.  The join partitions the sets by length, so that
only lengths whose ratio allows the threshold meet, indexes the rarest signatures of each set, and prunes before it counts.

Texts whose words hold no anchor followed by a whole chain use their words as signatures, so short texts can be
compared too.

Defined cases: null and empty texts (and texts without words) have the empty fingerprint, which is like itself (1) and
unlike every other (0); equal texts have equal fingerprints; rows of one ``doc_id`` follow each other by text; a null
``doc_id`` counts as the largest; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import Scratch, documents, map_texts, null_last, partitions, salted_join

#: common words of English, German, French and Spanish; they start a chain and do not count as content
ANCHORS = (
    "a an the is are was were be been to of in on at by for with from that this it and or as not "
    "der die das ein eine ist sind war und oder zu von mit auf den dem des sich nicht im in "
    "le la les un une des du de et ou est sont que qui dans pour par sur au aux "
    "el los las lo uno una y o es son del se en por con para su al no que"
)
#: content words of a signature
CHAIN = 2
_ANCHOR = np.unique([W.words(W.Slice(0, np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())])), W.ALNUM).hash[0]
                     for x in set(ANCHORS.split())]).astype(W.U64)
_BITS = np.zeros(1 << 16, bool)
_BITS[_ANCHOR & W.U64(0xFFFF)] = True


def signatures(s: W.Slice) -> list[np.ndarray]:
    """Sorted distinct 32-bit signatures of each text of a slice."""
    w = W.words(s, W.ALNUM)
    h, n = w.hash, len(w.hash)
    common = np.flatnonzero(_BITS[h & W.U64(0xFFFF)])
    common = common[_ANCHOR[np.minimum(np.searchsorted(_ANCHOR, h[common]), len(_ANCHOR) - 1)] == h[common]]
    is_common = np.zeros(n, bool)
    is_common[common] = True
    content = np.flatnonzero(~is_common)
    doc = w.doc()
    # the next CHAIN content words after each anchor, inside its text
    at = np.searchsorted(content, common)
    ok = at + CHAIN <= len(content)
    common, at = common[ok], at[ok]
    ok = doc[content[at + CHAIN - 1]] == doc[common] if len(at) else np.zeros(0, bool)
    common, at = common[ok], at[ok]
    sig = h[common].copy()
    for k in range(CHAIN):
        sig = W.mix(sig * W.U64(0x9E3779B97F4A7C15) + h[content[at + k]])
    sig = (sig >> W.U64(32)).astype(np.uint32)
    plain = (W.mix(h) >> W.U64(32)).astype(np.uint32)
    cut = np.searchsorted(doc[common], np.arange(len(s) + 1)) if n else np.zeros(len(s) + 1, int)
    return [np.unique(sig[cut[k] : cut[k + 1]] if cut[k] < cut[k + 1] else plain[w.first[k] : w.first[k + 1]])
            for k in range(len(s))]


def text_signatures(texts: list[bytes]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for s in W.slices(pa.array(texts, pa.large_binary())):
        out += signatures(s)
    return out


def fingerprint(sig: np.ndarray) -> str:
    """Four bytes for each signature, in order, as base64."""
    return base64.b64encode(sig.astype(">u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 without counting when their lengths rule ``least`` out."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large or not small:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def _edited(text: str, other: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of ``other`` (or all of it)."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def compare_next(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, set_length``.

    The next document is the one with the next smaller id (the smallest is followed by the largest).
    """
    spark = docs.sparkSession
    n = max(1, partitions(spark))
    rows = documents(docs).withColumn("id", null_last("doc_id")).withColumn("tie", F.xxhash64("text"))
    probe = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)] or [0.5], 20 * n).alias("q")).first()
    edges = sorted(set(probe.q or []))
    rows = rows.withColumn("bucket", F.size(F.filter(F.lit(edges) if edges else F.array().cast("array<bigint>"),
                                                     lambda x: x < F.col("id"))))
    # the first document of each bucket (one row a bucket) also ends the bucket before it
    tops = rows.groupBy("bucket").agg(F.max(F.struct("id", "tie")).alias("top")).collect()
    tops.sort(key=lambda r: -r.bucket)
    guests = [(r.top.id, r.top.tie, tops[k - 1].bucket) for k, r in enumerate(tops)]
    guest = spark.createDataFrame(guests, "id long, tie long, host int")
    rows = rows.join(F.broadcast(guest), ["id", "tie"], "left")  # at most one row a bucket
    rows = rows.select("doc_id", "id", "tie", "text", F.explode(F.when(
        F.col("host").isNull(), F.array(F.struct(F.col("bucket"), F.lit(False).alias("guest")))).otherwise(
        F.array(F.struct(F.col("bucket"), F.lit(False).alias("guest")),
                F.struct(F.col("host").alias("bucket"), F.lit(True).alias("guest"))))).alias("at"))
    rows = rows.select("at.bucket", "at.guest", "id", "tie", "doc_id", "text")
    rows = rows.repartition(n, "bucket").sortWithinPartitions("bucket", "guest", F.desc("id"), F.desc("tie"))
    return rows.select("bucket", "guest", "doc_id", "text").mapInArrow(_follow, _SCHEMA)


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, set_length long")


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs every document with the row after it; the last row of a batch waits for the next batch."""
    wait: tuple | None = None
    for b in batches:
        for k in range(0, b.num_rows, 500):
            part = b.slice(k, 500)
            rows = list(zip(*(part.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")), strict=True))
            if wait is not None:
                rows.insert(0, wait)
            yield from _emit([(x, y) for x, y in zip(rows, rows[1:], strict=False) if x[0] == y[0] and not x[1]])
            wait = rows[-1]


def _emit(pairs: list[tuple]) -> Iterator[pa.RecordBatch]:
    if not pairs:
        return
    texts = [x[3] or "" for x, _ in pairs]
    others = [y[3] or "" for _, y in pairs]
    edited = [_edited(t, o).encode() for t, o in zip(texts, others, strict=True)]
    own, changed, after = (text_signatures(x) for x in (
        [t.encode() for t in texts], edited, [o.encode() for o in others]))
    yield pa.RecordBatch.from_arrays(
        [pa.array([x[2] for x, _ in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array([fingerprint(s) for s in own]),
         pa.array([fingerprint(s) for s in changed]),
         pa.array([likeness(a, b) for a, b in zip(own, changed, strict=True)], pa.float64()),
         pa.array([likeness(a, b) for a, b in zip(own, after, strict=True)], pa.float64()),
         pa.array([len(s) for s in own], pa.int64())],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "set_length"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, set_length, sigs`` (sorted signatures) of every row."""

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for s in W.slices(b.column("text")):
            sets = signatures(s)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(s.first, len(s)), pa.array([len(x) for x in sets], pa.int32()),
                 pa.array([x.astype(np.int64) for x in sets], pa.list_(pa.int64()))], ["doc_id", "set_length", "sigs"])

    return map_texts(documents(docs), work, "doc_id long, set_length int, sigs array<long>")


def similar(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs of fingerprints with a Jaccard similarity of at least ``threshold``, and who has which fingerprint.

    Returns ``(a, b, likeness)`` between classes of equal fingerprints, and ``(doc_id, fp)`` as membership, so copies
    are never paired.  Sets are partitioned by length (ratio ``threshold`` per step): a set meets its own partition
    and the next one.  Only the ``len - ceil(threshold * len) + 1`` rarest signatures are indexed, and a pair is
    dropped by its lengths before anything is counted.
    """
    scratch = Scratch(docs.sparkSession, "spotsigs")
    rows = scratch.save(fingerprints(docs).withColumn("fp", F.sha2(F.concat_ws(",", "sigs"), 256)), "sets")
    sets = rows.where("set_length > 0").groupBy("fp").agg(F.first("set_length").alias("n"), F.first("sigs").alias("sigs"))
    sets = scratch.save(sets.withColumn("part", F.floor(F.log("n") / -np.log(threshold) + 1e-9).cast("int")), "classes")
    each = sets.select("fp", "n", "part", F.explode("sigs").alias("sig"))
    common = each.groupBy("sig").agg(F.count(F.lit(1)).alias("f"))
    ranked = salted_join(each, common.where("f > 1"), ["sig"], "fp").groupBy("fp", "n", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "sig"))).alias("by"))
    keep = F.slice("by", F.lit(1), F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)
    index = ranked.select("fp", "n", "part", F.explode(keep).alias("x")).where("x.f > 1").select("fp", "n", "part", "x.sig")
    a = index.select(F.col("fp").alias("a"), F.col("n").alias("na"), "sig", "part")
    b = index.select(F.col("fp").alias("b"), F.col("n").alias("nb"), "sig",
                     F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"))
    shorter = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = a.join(b, ["sig", "part"]).where(shorter & (F.col("na") >= F.col("nb") * threshold - 1e-9)).select("a", "b").distinct()
    left, right = sets.select(F.col("fp").alias("a"), F.col("sigs").alias("x")), sets.select(F.col("fp").alias("b"), F.col("sigs").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    found = pairs.join(left, "a").join(right, "b").withColumn("likeness", both / (F.size("x") + F.size("y") - both))
    return found.where(F.col("likeness") >= threshold - 1e-12).select("a", "b", "likeness"), rows.select("doc_id", "fp")
