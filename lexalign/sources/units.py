"""Commit protocol for outputs that are written unit by unit (K2, K5, K6 with J3).

A unit is one value of the key columns, say ``(lang_pair, model, split)``.  A ``UnitTable`` under ``root`` holds

* ``data/run=<run>/<keys>/``: rows, written by Spark's own committer; a run never touches another run's folders;
* ``manifests/run=<run>/``: a row per unit of the run with its number of rows (0 for a unit that gave none), counted from
  the files that were written;
* ``commits/<version>.json``: the run that this version adds.  It is written under another name and renamed where no
  file of the name exists, so it appears whole or not at all, and two writers cannot take one version.

Readers start from the commits: a run without one (a failed or running write) is not seen.  The latest committed run of
a unit counts, so writing a unit again replaces that unit and leaves the others.  An older ``version`` can be read as
it was.  ``vacuum`` deletes runs that no unit refers to any more.

A null key is a unit like any other.  The table's keys, columns and format are fixed by its first commit.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

FORMATS = ("parquet", "text")
_COMMIT = "run string, schema string, format string"


def _same(left: DataFrame, right: DataFrame, cols) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & left[c].eqNullSafe(right[c])
    return out


class UnitTable:
    def __init__(self, spark: SparkSession, root: str, keys, fmt: str = "parquet"):
        if fmt not in FORMATS:
            raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
        self.spark, self.root, self.keys, self.fmt = spark, root.rstrip("/"), list(keys), fmt
        if not self.keys or "run" in self.keys:
            raise ValueError("a unit table needs key columns, none of them named 'run'")

    # files

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        """Names in a folder of the table (one per commit, or per run)."""
        fs, p = self._fs(), self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("commits") if n.endswith(".json")]

    def _publish(self, text: str) -> int:
        """Put the commit file in place under the next free version."""
        jvm, fs = self.spark._jvm, self._fs()
        held = self._path("commits", f".{uuid.uuid4().hex}")
        out = fs.create(held, False)
        out.write(text.encode())
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        while True:
            version = max(self.versions(), default=0) + 1
            try:
                context.rename(held, self._path("commits", f"{version:010d}.json"), options)
                return version
            except Py4JJavaError as e:
                if "FileAlreadyExists" not in str(e.java_exception):
                    raise

    # writing

    def stage(self, df: DataFrame, run: str | None = None) -> str:
        """Write the rows of ``df`` as a run that nothing refers to yet."""
        run = run or uuid.uuid4().hex
        rest = [c for c in df.columns if c not in self.keys]
        out = df.select(*rest, F.lit(run).alias("run"), *self.keys).write.mode("append").partitionBy("run", *self.keys)
        out.format(self.fmt).save(f"{self.root}/data")
        return run

    def commit(self, run: str, schema: StructType, units: DataFrame | None = None) -> int:
        """Make a staged run visible; ``units`` lists units that ran, so that those without rows are known as done."""
        types = StructType([schema[k] for k in self.keys])
        rest = StructType([f for f in schema if f.name not in self.keys])
        full = StructType([*rest, StructField("run", StringType()), *types])
        counts = self._data(full).where(F.col("run") == run).groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows"))
        if units is not None:
            counts = counts.unionByName(units.select(*self.keys, F.lit(0).cast("long").alias("n_rows"))).groupBy(*self.keys).agg(
                F.sum("n_rows").alias("n_rows"))
        counts.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{self.root}/manifests")
        return self._publish(json.dumps({"run": run, "schema": full.json(), "format": self.fmt}))

    def write(self, df: DataFrame, units: DataFrame | None = None) -> int:
        """Stage and commit: the units of ``df`` (and of ``units``) are replaced, all others stay.  Returns the version."""
        return self.commit(self.stage(df), df.schema, units)

    # reading

    def _data(self, full: StructType) -> DataFrame:
        p = self._path("data")
        if not self._fs().exists(p):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).format(self.fmt).load(f"{self.root}/data")

    def _commits(self, version: int | None) -> DataFrame | None:
        known = [v for v in self.versions() if version is None or v <= version]
        if not known:
            return None
        read = self.spark.read.schema(_COMMIT).json([f"{self.root}/commits/{v:010d}.json" for v in known])
        name = F.element_at(F.split(F.input_file_name(), "/"), -1)
        return read.select("run", "schema", F.regexp_extract(name, r"(\d+)\.json", 1).cast("long").alias("version"))

    def schema(self, version: int | None = None) -> StructType | None:
        commits = self._commits(version)
        row = commits.orderBy(F.desc("version")).select("schema").first() if commits is not None else None
        return StructType.fromJson(json.loads(row[0])) if row else None

    def units(self, version: int | None = None) -> DataFrame | None:
        """``(keys, n_rows, run, version)``: the committed units; none (``None``) before the first commit."""
        full, commits = self.schema(version), self._commits(version)
        if full is None:
            return None
        fields = StructType([*[full[k] for k in self.keys], StructField("n_rows", LongType()), StructField("run", StringType())])
        rows = self.spark.read.schema(fields).parquet(f"{self.root}/manifests").join(commits.select("run", "version"), "run")
        w = Window.partitionBy(*self.keys).orderBy(F.desc("version"))
        return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*self.keys, "n_rows", "run", "version")

    def read(self, version: int | None = None) -> DataFrame | None:
        """Rows of the committed units.  Runs and keys are folders, so other units' files are not opened."""
        full = self.schema(version)
        if full is None:
            return None
        data, last = self._data(full), self.units(version).where("n_rows > 0").select("run", *self.keys)
        rest = [c for c in full.names if c not in self.keys and c != "run"]
        return data.join(last, (data["run"] == last["run"]) & _same(data, last, self.keys), "left_semi").select(*self.keys, *rest)

    def pending(self, work: DataFrame) -> DataFrame:
        """The units of ``work`` that are not committed."""
        done = self.units()
        return work if done is None else work.join(done, _same(work, done, self.keys), "left_anti")

    def vacuum(self) -> list[str]:
        """Delete runs that are committed and replaced unit for unit, or were never committed.  Do not run it beside a writer."""
        done = self.units()
        live = {r[0] for r in done.select("run").distinct().collect()} if done is not None else set()
        gone = sorted({n[4:] for f in ("data", "manifests") for n in self._names(f) if n.startswith("run=")} - live)
        for run in gone:
            for folder in ("data", "manifests"):
                self._fs().delete(self._path(folder, f"run={run}"), True)
        return gone
