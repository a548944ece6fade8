"""Table-set sources and sinks, run counters.

A table set is published as a whole: ``NewVersion`` writes every table to a folder of its own and then one manifest, by
a rename.  Readers (``read_tables``) follow the newest manifest, so they see either all tables of a run or all of the run
before it.  A run that fails leaves a folder without a manifest, which nobody reads."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.operators.groupwise import leaderboard
from podium.session import hadoop_path

VERSIONS = "versions"
MANIFEST = "manifest.json"


def write_tables(path: str, tables: Mapping[str, DataFrame], mode: str = "overwrite",
                 partition_by: Mapping[str, list[str]] | None = None) -> dict[str, str]:
    """Multi-table sink: each frame to ``<path>/<name>`` as parquet."""
    out = {}
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        w = df.write.mode(mode)
        if partition_by and partition_by.get(name):
            w = w.partitionBy(*partition_by[name])
        w.parquet(target)
        out[name] = target
    return out


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(number, committed) of every version folder, ascending."""
    folder, fs = hadoop_path(spark, f"{path.rstrip('/')}/{VERSIONS}")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        at = status.getPath()
        if at.getName().isdigit():
            out.append((int(at.getName()), fs.exists(hadoop_path(spark, f"{at.toString()}/{MANIFEST}")[0])))
    return sorted(out)


def current_version(spark: SparkSession, path: str) -> int | None:
    """The number of the newest published version; None where there is none."""
    return max((n for n, committed in _versions(spark, path) if committed), default=None)


class NewVersion:
    """A new version of the table set at ``path``, published when the ``with`` block ends without an error.

    Each version number is claimed by creating a file that must not exist, so two writers never share a folder; of two
    that both publish, the higher number counts.  ``rows`` holds the row count of each table, observed in the pass that
    writes it (above all shuffles, so a task run again after a lost executor is not counted twice)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.base = spark, path.rstrip("/")
        self.paths: dict[str, str] = {}
        self.rows: dict[str, int] = {}

    def __enter__(self) -> NewVersion:
        number = max((n for n, _ in _versions(self.spark, self.base)), default=0) + 1
        while not self._claim(number):
            number += 1
        self.number, self.folder = number, self._folder(number)
        return self

    def _folder(self, number: int) -> str:
        return f"{self.base}/{VERSIONS}/{number:010d}"

    def _claim(self, number: int) -> bool:
        path, fs = hadoop_path(self.spark, f"{self._folder(number)}/claimed")
        try:
            fs.create(path, False).close()
        except Py4JJavaError as err:
            if "AlreadyExists" in err.java_exception.getClass().getName() and fs.exists(path):
                return False
            raise
        return True

    def write(self, name: str, df: DataFrame, partition_by: Iterable[str] = (), form: str = "parquet") -> str:
        """Write one table of the set; returns its path."""
        target, seen = f"{self.folder}/{name}", Observation()
        w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").format(form)
        partition_by = list(partition_by)
        (w.partitionBy(*partition_by) if partition_by else w).save(target)
        self.rows[name] = int(seen.get.get("rows", 0))
        self.paths[name] = target
        return target

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            return
        text = json.dumps({"version": self.number, "rows": self.rows})
        draft, fs = hadoop_path(self.spark, f"{self.folder}/{MANIFEST}.draft")
        stream = fs.create(draft, True)
        stream.writeBytes(text)
        stream.close()
        final, _ = hadoop_path(self.spark, f"{self.folder}/{MANIFEST}")
        if not fs.rename(draft, final):
            raise OSError(f"version {self.number} of {self.base} could not be published")


def publish_tables(spark: SparkSession, path: str, tables: Mapping[str, DataFrame],
                   partition_by: Mapping[str, list[str]] | None = None) -> dict[str, str]:
    """Write all ``tables`` as one new version of the set at ``path``; returns the paths."""
    with NewVersion(spark, path) as new:
        for name, df in tables.items():
            new.write(name, df, (partition_by or {}).get(name, ()))
    return new.paths


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove the versions below the ``keep`` newest published ones, unpublished leftovers among them; a reader that
    started on an older one loses it.  Returns the numbers removed."""
    every = _versions(spark, path)
    kept = [n for n, committed in every if committed][-keep:]
    gone = [n for n, _ in every if kept and n < kept[0]]
    for n in gone:
        folder = f"{path.rstrip('/')}/{VERSIONS}/{n:010d}"
        # the manifest goes first: a version is never published with tables missing
        for target in (f"{folder}/{MANIFEST}", folder):
            at, fs = hadoop_path(spark, target)
            fs.delete(at, True)
    return gone


def read_tables(spark: SparkSession, path: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Multi-table source: ``{name: frame}``, all of the newest published version where the folder holds versions, else
    the plain sub-folders; a missing table raises (PATH_NOT_FOUND)."""
    base, number = path.rstrip("/"), current_version(spark, path)
    root = base if number is None else f"{base}/{VERSIONS}/{number:010d}"
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def read_csv_text(spark: SparkSession, path: str, rename: Mapping[str, str], line_no: str | None = None,
                  malformed: str | None = None) -> DataFrame:
    """CSV with a header, every column read as text (typed later by the tolerant
    number rule), columns located **by header name** and renamed with ``rename``
    (header -> engine column); a column absent from the file becomes NULL.
    A missing file yields zero rows, not an error.

    ``line_no`` adds each record's place in the files (1..n, files by path): records are ordered by file, by the byte
    offset of their split and by their order inside it, so the place does not depend on how the files are split.
    ``malformed`` adds the text of each record whose number of fields is not that of the header, NULL for the others."""
    targets = list(dict.fromkeys(rename.values()))
    extra = [T.StructField(line_no, T.LongType())] if line_no else []
    extra += [T.StructField(malformed, T.StringType())] if malformed else []
    try:
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in targets] + extra))
    headers = raw.columns
    if malformed:
        schema = T.StructType([*raw.schema.fields, T.StructField(malformed, T.StringType())])
        # without pruning every record's fields are counted, whatever columns are asked for
        raw = spark.read.schema(schema).option("header", True).option("columnPruning", False) \
            .option("columnNameOfCorruptRecord", malformed).csv(path)
    cols = []
    for t in targets:
        src = [h for h, v in rename.items() if v == t and h in headers]
        cols.append((F.col(f"`{src[0]}`") if src else F.lit(None)).cast("string").alias(t))
    if malformed:
        cols.append(F.col(malformed))
    if not line_no:
        return raw.select(*cols)
    at = {"__file": F.col("_metadata.file_path"), "__offset": F.col("_metadata.file_block_start"),
          "__record": F.monotonically_increasing_id()}
    placed = leaderboard(raw.select(*cols, *[c.alias(n) for n, c in at.items()]), list(at), place=line_no)
    return placed.select(*targets, line_no, *([malformed] if malformed else []))


def run_metrics(**counts: DataFrame | int) -> DataFrame:
    """Run counters as rows (metric, value): the row count of every frame; numbers that were observed while a table was
    written are taken as they are."""
    spark = next((c.sparkSession for c in counts.values() if isinstance(c, DataFrame)), None) or SparkSession.active()
    out = None
    for name, c in counts.items():
        one = c.agg(F.count(F.lit(1)).cast("bigint").alias("value")) if isinstance(c, DataFrame) \
            else spark.range(1).select(F.lit(c).cast("bigint").alias("value"))
        one = one.select(F.lit(name).alias("metric"), "value")
        out = one if out is None else out.unionByName(one)
    return out
