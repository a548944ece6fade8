"""Exact deduplication by deterministic block naming (DataFrame functions only).

Every text is cut into blocks of ``block_bytes`` bytes.  The distinct blocks are sorted and numbered; two blocks get
the same number exactly if their bytes are equal.  Then adjacent numbers are paired, the distinct pairs sorted and
numbered, and so on until each document has one number: documents with as many blocks and the same number have
identical texts, without reliance on a digest.

Sorting goes by (xxhash64, bytes).  Only the first part travels with each occurrence: a block whose hash is shared with
different bytes also carries its rank among those, so the pair (hash, rank) names its bytes exactly.  Block bytes are
shuffled once, after map-side removal of equal ones; all later steps move integers.

Defined cases: null text counts as empty; an empty text is one empty block.  Of equal texts the row with the largest
``doc_id`` stays (null ids are the smallest; of repeated rows with that id exactly one stays).  An empty table gives an
empty result.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.shared import Scratch, ascii_lower, free_name, with_keys

BLOCK_BYTES = 8192


def _blocks(text: Column, size: int) -> Column:
    """(pos, block) for each block of ``size`` bytes of a binary; one empty block if there are none."""
    last = F.greatest(F.ceil(F.octet_length(text) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        i.alias("pos"), F.substring(text, i * size + 1, F.lit(size)).alias("block")))


def _numbered(keys: DataFrame, *cols: str) -> DataFrame:
    """Distinct keys in sort order with an increasing number, made within the range partitions of the sort."""
    return keys.distinct().orderBy(*cols).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, id, n_blocks, name, sha256) per row: equal texts have equal (n_blocks, name)."""
    spark = docs.sparkSession
    tmp = Scratch(spark, "names")
    norm = ascii_lower(F.col("text")) if text is None else text
    base = docs.select(F.col(id_col).alias("id"), norm.cast("binary").alias("text"))

    # blocks whose hash is shared with other bytes: usually none
    blocks = (base.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("b"))
              .select(F.xxhash64("b.block").alias("k"), F.col("b.block").alias("block")))
    shared = tmp.write(blocks.distinct().groupBy("k").count().where("count > 1").select("k"))
    ranks = tmp.write(blocks.join(shared, "k", "left_semi").distinct().select(
        "k", "block", F.row_number().over(Window.partitionBy("k").orderBy("block")).alias("rank")))

    # one scan numbers the rows; what else is known of a row stands on its first block
    first = lambda c: F.when(F.col("b.pos") == 0, F.col(c)).alias(c)
    occ = (base.select(F.monotonically_increasing_id().alias("row"), "id", F.sha2("text", 256).alias("sha256"),
                       _blocks(F.col("text"), block_bytes).alias("blocks"))
           .select("row", "id", "sha256", F.size("blocks").alias("n_blocks"), F.explode("blocks").alias("b"))
           .select("row", "n_blocks", first("id"), first("sha256"), F.col("b.pos").alias("pos"),
                   F.xxhash64("b.block").alias("k"), F.col("b.block").alias("block")))
    occ = tmp.write(occ.join(ranks, ["k", "block"], "left").drop("block")
                    .withColumn("rank", F.coalesce(F.col("rank"), F.lit(1))))
    names = tmp.write(_numbered(occ.select("k", "rank"), "k", "rank"))
    head = ["row", "id", "n_blocks", "name", "sha256"]
    named = tmp.write(occ.join(names, ["k", "rank"]).select(*head, "pos"))
    tmp.drop(occ, names, ranks, shared)

    done = [named.where("n_blocks = 1").select(*head)]
    level = named.where("n_blocks > 1").select("row", F.col("n_blocks").alias("left"), "pos", "name")
    most = named.agg(F.max("n_blocks")).first()[0] or 1
    about = named.where("n_blocks > 1 and pos = 0").select("row", "id", "n_blocks", "sha256")
    while most > 1:
        even = F.col("pos") % 2 == 0
        pairs = tmp.write(level.groupBy("row", (F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max("left").alias("left"), F.max(F.when(even, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")))
        names = tmp.write(_numbered(pairs.select("a", "b"), "a", "b"))
        most = (most + 1) // 2
        now = tmp.write(pairs.join(names, ["a", "b"]).select(
            "row", F.ceil(F.col("left") / 2).cast("int").alias("left"), "pos", "name"))
        tmp.drop(pairs, names)
        done.append(about.join(now.where("left = 1").select("row", "name"), "row").select(*head))
        level = now.where("left > 1")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return tmp.write(out)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    named = identities(docs, id_col, text, block_bytes)
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "row")
    # written, so that the join below can split the rows of a large group
    groups = Scratch(docs.sparkSession, "groups").write(
        named.groupBy("n_blocks", "name").agg(F.max(order).alias("last"), F.count(F.lit(1)).alias("group_size")))
    return (named.join(groups, ["n_blocks", "name"])
            .select(F.col("id").alias(id_col), F.col("last.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("last.row")).alias("kept"), F.col("sha256").alias("text_sha256")))


def keep_one(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that stay, with the columns they came with.  Rows are told apart by a key of their own in a written
    copy, and equal texts by their block names alone."""
    tmp = Scratch(docs.sparkSession, "kept")
    key = free_name(docs, "podium_row")
    rows = tmp.write(docs.withColumn(key, F.monotonically_increasing_id()))
    groups = tmp.write(exact_dedup(rows, key).select(F.col(key).alias("row"), F.col("keep_id").alias("group"), "group_size"))
    ids = rows.select(F.col(key).alias("row"), F.col(id_col).alias("id"))
    last = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "row")).alias("last")
    repeated = groups.where("group_size > 1").join(ids, "row").groupBy("group").agg(last).select(F.col("last.row").alias(key))
    kept = tmp.write(groups.where("group_size = 1").select(F.col("row").alias(key)).unionByName(repeated))
    return with_keys(rows, key, kept).select(*docs.columns)
