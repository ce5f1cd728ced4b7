"""Secret scans with an incremental blob ledger, in DataFrame functions alone.

A version (a document at a path) is known by its content: ``blob`` is the SHA-256 of its text.  The ledger is a Parquet
table that only grows, with a row per blob and scan: the rules that were run on it (name and version) and what they
found.  ``scan`` looks up which (blob, rule version) pairs the ledger lacks, reads each of those blobs once, however
many versions hold it, runs just the rules it lacks and appends.  A rule's version is a digest of its pattern, length
and gate, so a changed rule is a new pair and an unchanged one never runs twice.  ``findings`` joins what the ledger
holds for the current rules back to every path.

Places come from two passes of the same regular expression: ``regexp_extract_all`` gives the matches and ``split`` the
text between them, so running sums of their lengths (a window over one rule's matches in one blob) are the places in
code points.  A rule's keywords are looked for first; only texts that hold one are searched.

Skew: copies are merged in the map tasks before texts move.  Only blobs that the ledger lacks move: a bitmap of their
digests filters the texts ahead of the join.

Cases: a null text is empty.  A null ``doc_id`` is a path like another, and rows that repeat an id are versions of their
own.  Very long texts are scanned whole.  Other columns are ignored unless asked for as path columns.  Empty tables
give an empty result and add nothing to the ledger.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import Scratch, maybe_in


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and without overlap, whose ``group`` has at least ``least`` code points.

    ``gate``: lower-cased texts without any of these hold no match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    gate: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        text = "\n".join([self.pattern, str(self.group), str(self.least), *self.gate])
        return f"{self.kind}@{hashlib.sha256(text.encode()).hexdigest()[:12]}"


#: fixed values: the base kinds of the contract.  Runs of hex digits and access keys that are too short hold no long
#: one, so their length stands in the pattern; a short assignment uses up its text, so it is dropped afterwards.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         ("password", "passwd", "secret", "token", "api_key", "apikey")),
    Rule("access", r"AKIA[A-Z0-9]{14,}", gate=("akia",)),
    Rule("hex", r"[0-9a-f]{16,}"),
)

#: kinds of the method's own
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", gate=("private key",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", gate=("eyj",)),
    Rule("forge", r"gh[opsur]_[A-Za-z0-9]{30,}|glpat-[A-Za-z0-9_-]{20,}", gate=("gho_", "ghp_", "ghs_", "ghu_", "ghr_", "glpat-")),
    Rule("chat", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", gate=("xox",)),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}", gate=("aiza",)),
    Rule("pay", r"[rs]k_live_[A-Za-z0-9]{16,}", gate=("k_live_",)),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{20,}", gate=("bearer",)),
    Rule("login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\x00-\x20/:@\x7F]+:[^\x00-\x20/@\x7F]+@", gate=("://",)),
)

RULES = BASE + ADDED
SPANS = "array<struct<start: long, rank: int, end: long, kind: string>>"
_LEDGER = "blob string, rules array<string>, found array<struct<rule: string, start: long, end: long>>"


def versions(docs: DataFrame, *paths: str) -> DataFrame:
    """``(paths, blob, text)``: every version with the address of its content."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(*paths, F.sha2(text, 256).alias("blob"), text.alias("text"))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none where nothing was written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def _lacking(v: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...], path: Scratch) -> DataFrame:
    """``(blob, lacks)``: blobs among ``v`` and the current rules that the ledger has not seen on them."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    lacks = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
    todo = v.select("blob").distinct().join(seen, "blob", "left").select("blob", lacks.alias("lacks"))
    return path.save(todo.where(F.size("lacks") > 0), "lacking")


def _matches(rule: Rule) -> tuple[Column, Column]:
    """All matches in ``text`` if the rule is asked for and its gate is open, and the lengths that decide what stays."""
    ask = F.array_contains("lacks", rule.key)
    if rule.gate:
        ask = ask & F.lower("text").rlike("|".join(g.replace(".", r"\.") for g in rule.gate))
    hits = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    size = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else F.array().cast("array<string>")
    none = F.array().cast("array<string>")
    return F.when(ask, hits).otherwise(none), F.when(ask, size).otherwise(none)


def _lengths(a: Column) -> Column:
    return F.transform(a, lambda x: F.length(x))


def _found(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, lacks, raw)``: for every rule with matches, the lengths of the matches, of what lies between them and of the deciding group."""
    cols = {}
    for i, r in enumerate(rules):
        cols[f"_hit{i}"], cols[f"_part{i}"] = _matches(r)
    b = blobs.select("blob", "lacks", "text", *[c.alias(n) for n, c in cols.items()])
    raw = []
    for i, r in enumerate(rules):
        gaps = F.slice(_lengths(F.split("text", F.lit(r.pattern), -1)), F.lit(1), F.size(f"_hit{i}"))
        part = _lengths(F.col(f"_part{i}")) if r.group else _lengths(F.col(f"_hit{i}"))
        raw.append(F.when(F.size(f"_hit{i}") > 0, F.struct(F.lit(r.key).alias("rule"), F.arrays_zip(
            gaps.alias("gap"), _lengths(F.col(f"_hit{i}")).alias("size"), part.alias("part")).alias("hits"))))
    return b.select("blob", "lacks", F.filter(F.array(*raw), lambda x: x.isNotNull()).alias("raw"))


def _places(raw: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, rule, start, end)`` of the matches that are long enough."""
    least = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.least))])
    hits = raw.select("blob", F.explode("raw").alias("r")).select("blob", "r.rule", F.posexplode("r.hits").alias("k", "h"))
    w = Window.partitionBy("blob", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("h.gap") + F.col("h.size")).cast("long")).over(w)
    at = hits.select("blob", "rule", end.alias("end"), F.col("h.size").alias("size"), (F.col("h.part") >= least[F.col("rule")]).alias("stays"))
    return at.where("stays").select("blob", "rule", (F.col("end") - F.col("size")).alias("start"), "end")


def scan(v: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Run on every blob of the versions ``v`` the rules that the ledger at ``ledger_path`` lacks for it, and append."""
    spark = v.sparkSession
    path = Scratch(spark, "secrets")
    ledger = open_ledger(spark, ledger_path)
    if ledger.isEmpty():
        lacks = F.array(*[F.lit(r.key) for r in rules])
        blobs = v.groupBy("blob").agg(F.first("text").alias("text")).withColumn("lacks", lacks)
    else:
        todo = _lacking(v, ledger, rules, path)
        blobs = maybe_in(v.select("blob", "text"), todo, "blob").groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")
    raw = path.save(_found(blobs, rules), "raw")
    spans = _places(raw, rules).groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("rule", "start", "end"))).alias("found"))
    rows = raw.select("blob", "lacks").join(spans, "blob", "left").select(
        "blob", F.col("lacks").alias("rules"), F.coalesce("found", F.array().cast("array<struct<rule:string,start:bigint,end:bigint>>")).alias("found"))
    rows.write.mode("append").parquet(ledger_path)


def findings(v: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns of ``v`` but its text, and ``spans``: ``(start, rank, end, kind)`` by start, then kind as listed."""
    spark = v.sparkSession
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.struct(F.lit(i).alias("rank"), F.lit(r.kind).alias("kind")))])
    hits = open_ledger(spark, ledger_path).select("blob", F.explode("found").alias("f")).withColumn("r", rank[F.col("f.rule")])
    spans = hits.where("r is not null").groupBy("blob").agg(F.array_sort(F.collect_set(
        F.struct("f.start", "r.rank", "f.end", "r.kind"))).alias("spans"))
    spans = Scratch(spark, "secrets").save(spans, "spans")  # a table: a blob of many paths can be split over tasks in the join
    return v.drop("text").join(spans, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, blob, spans)`` for every row of ``docs``; without a ledger a new one is kept in the shared folder."""
    where = ledger_path or f"{Scratch(docs.sparkSession, 'secrets').path}/ledger"
    v = versions(docs, "doc_id")
    scan(v, where, rules)
    return findings(v, where, rules)
