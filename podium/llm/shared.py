"""Helpers shared by the operators: input columns, ASCII lower case, tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import ship  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case and nothing else; null counts as empty.  ``lower`` does just that where all is ASCII, at a
    third of the cost of ``translate``."""
    text = F.coalesce(col, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_keys(rows: DataFrame, key: str, keys: DataFrame, kept: bool = True) -> DataFrame:
    """The rows whose ``key`` (0 or more, as ``monotonically_increasing_id`` gives it) is among ``keys``, a table with that
    column; without ``kept`` the others.  The rows stay where they are: the keys meet them as words of 64 bits, one bit a
    row, so texts are not shuffled for a list of row numbers."""
    word, bit = F.shiftright(key, 6), F.col(key).bitwiseAND(63).cast("int")
    marks = keys.groupBy(word.alias("podium_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))")).alias("podium_bits"))
    met = rows.join(F.broadcast(marks), word == F.col("podium_word"), "left")
    marked = F.coalesce(F.getbit("podium_bits", bit) == 1, F.lit(False))
    return met.where(marked if kept else ~marked).select(*[F.col(f"`{c}`") for c in rows.columns])


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Where it is unset a local session gets one of its own;
    on a cluster a driver-local folder would be wrong, so that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="podium-shared-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


#: Folders that operators made inside the ``Scratch.passing`` block that is running, if one is.
_MADE: ContextVar[list[str] | None] = ContextVar("podium_scratch_made", default=None)


class Scratch:
    """Tables written to the shared folder by one call of an operator.

    Writing cuts the lineage: a lost executor re-reads files.  Names hold the application id and a UUID.
    ``drop`` removes a table that no later step reads; the rest goes with ``Scratch.clean(spark)``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/podium-llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        made = _MADE.get()
        if made is not None:
            made.append(self.root)

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._podium_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            _remove(self.spark, df._podium_path)

    @staticmethod
    @contextmanager
    def passing(spark: SparkSession) -> Iterator[None]:
        """What operators write inside the block is removed at its end; their results must have been written by then."""
        made: list[str] = []
        token = _MADE.set(made)
        try:
            yield
        finally:
            _MADE.reset(token)
            for root in made:
                _remove(spark, root)

    @staticmethod
    def clean(spark: SparkSession) -> None:
        """Remove all that this application's operators wrote; call it when their results have been read."""
        _remove(spark, f"{shared_folder(spark)}/podium-llm-{spark.sparkContext.applicationId}")


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
