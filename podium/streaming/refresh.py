"""The daily recompute as a Structured Streaming job.

New result pages land as parquet files ``(url, html)`` in a folder.  Each run
(``availableNow`` trigger, e.g. once a day) reads only the files not seen
before (the checkpoint remembers them).  A page that is delivered again replaces
what its URL held: every epoch stores the URLs it brought and their extracted
rows under ``epoch=<id>`` with overwrite (a replayed batch rewrites the same
folders, so the store stays exactly-once), and of each URL only the rows of its
latest epoch count; within one epoch the newest file wins.  The store holds rows
without lineage: events are joined, and the crawl order is numbered, over all
rows at each refresh, so order keys never depend on the run that brought a row.
Results and boards are published together as one version (``sources.tables.read_tables``
follows the newest); the ``keep`` newest versions stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from podium.plans import boards
from podium.sources.html_tables import crawl_order, extract_results, with_lineage
from podium.sources.tables import NewVersion, expire_versions

PAGES_SCHEMA = "url string, html string"


def latest_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """The extracted rows that count: of each URL those of its latest delivery."""
    base = out_dir.rstrip("/")
    latest = spark.read.parquet(f"{base}/delivered").groupBy("url").agg(F.max("epoch").alias("epoch"))
    return spark.read.parquet(f"{base}/rows").join(latest, ["url", "epoch"]).drop("epoch")


def refresh_boards(spark: SparkSession, pages_dir: str, events: DataFrame, out_dir: str,
                   checkpoint_dir: str | None = None, keep: int = 7) -> StreamingQuery:
    """Start one ``availableNow`` refresh; returns the query (``awaitTermination()`` to wait)."""
    base = out_dir.rstrip("/")
    ckpt = checkpoint_dir or f"{base}/_checkpoint"

    def batch(pages: DataFrame, epoch_id: int) -> None:
        # the newest delivery of each URL is known from its file, so page texts are not grouped
        file = F.struct("file_time", "file_path")
        newest = pages.groupBy("url").agg(F.max(file).alias("f")).select("url", F.col("f.file_time").alias("file_time"), F.col("f.file_path").alias("file_path"))
        newest.select("url").write.mode("overwrite").parquet(f"{base}/delivered/epoch={epoch_id}")
        rows = extract_results(pages.withColumn("url", F.to_json(F.struct("url", "file_time", "file_path"))))
        key = F.from_json("url", "url string, file_time timestamp, file_path string")
        rows = rows.withColumn("url", key).select("url.*", *[c for c in rows.columns if c != "url"])
        rows = rows.join(newest, ["url", "file_time", "file_path"], "left_semi").drop("file_time", "file_path")
        rows.write.mode("overwrite").parquet(f"{base}/rows/epoch={epoch_id}")
        results = with_lineage(latest_rows(spark, base), crawl_order(events))
        with NewVersion(spark, base) as new:
            results = spark.read.schema(results.schema).parquet(new.write("results", results))
            for name, board in (("average", boards.average_board), ("award", boards.award_board), ("team", boards.team_board)):
                new.write(name, board(results))
        expire_versions(spark, base, keep)

    stream = (spark.readStream.schema(PAGES_SCHEMA).parquet(pages_dir)
              .select("url", "html", F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path").alias("file_path")))
    return (stream.writeStream.foreachBatch(batch)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start())
