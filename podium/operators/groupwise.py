"""Per-group selection, ordinals and global places.

Orders are lists of ``Column`` sort expressions (``F.col('x').desc_nulls_last()``)
or column names (ascending, nulls last).  Every order must end in a unique
tie-break for results to be deterministic; callers append one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium import constants as K
from podium.session import scratch_path


def _order(order: Sequence) -> list[Column]:
    out = []
    for o in order:
        out.append(F.col(o).asc_nulls_last() if isinstance(o, str) else o)
    return out


def running_number(keys: Sequence[str], order: Sequence) -> Column:
    """1, 2, 3 ... inside each group of ``keys`` in ``order`` (cumcount + 1)."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order)))


def segmented_number(df: DataFrame, keys: Sequence[str], order: Sequence, number: str = "rn",
                     partitions: int | None = None) -> DataFrame:
    """``running_number`` for groups of any size: no task sorts a whole group.

    Rows are range-partitioned on (keys, order), so that a large group is cut by its own order, and written once with their
    partition and place in it (the sampled bounds are random per evaluation).  Each piece of a group inside a partition is
    numbered by itself; what the group holds in earlier partitions is added.  Only groups that reach over a bound have
    such an offset: at most two pieces a partition, which is the proven size of the broadcast side."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [*[F.col(k).asc_nulls_first() for k in keys], *_order(order)]
    path = scratch_path(spark, "numbered")
    (df.repartitionByRange(n, *sort).sortWithinPartitions(*sort).withColumn("__pid", F.spark_partition_id())
     .withColumn("__mid", F.monotonically_increasing_id()).write.mode("errorifexists").parquet(path))
    fixed = spark.read.parquet(path)
    pieces = fixed.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__n"))
    whole = pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("__pieces"), F.sort_array(F.collect_list(F.struct("__pid", "__n"))).alias("__all"))
    cut = whole.where("__pieces > 1").select(*keys, F.expr("""inline(transform(__all, (p, i) -> named_struct(
        '__p', p.__pid, '__off', aggregate(slice(__all, 1, i), 0L, (a, q) -> a + q.__n))))"""))
    cut = cut.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__p", "__off")
    same = F.col("__pid") == F.col("__p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    # a piece is at most one partition of the copy, whatever its group
    out = fixed.withColumn("__local", F.row_number().over(Window.partitionBy("__pid", *keys).orderBy("__mid")))
    out = out.join(F.broadcast(cut), same, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__local") + F.coalesce("__off", F.lit(0))).cast("bigint").alias(number))


CHUNK = 1024


def chunked_list(df: DataFrame, keys: Sequence[str], item: Column, number: str, name: str, size: int = CHUNK) -> DataFrame:
    """Per group the array of ``item`` in the order of ``number`` (1, 2, 3 ... inside the group), assembled in two levels:
    ``size`` items at a time, then the chunks by their number.  Only the last step holds a whole group, as its result does."""
    rows = df.select(*keys, F.floor((F.col(number) - 1) / size).cast("bigint").alias("__chunk"), F.struct(F.col(number).alias("n"), item.alias("v")).alias("__item"))
    chunks = rows.groupBy(*keys, "__chunk").agg(F.array_sort(F.collect_list("__item")).alias("__items"))
    return (chunks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__chunk", "__items"))).alias("__c"))
            .select(*keys, F.transform(F.flatten(F.transform("__c", lambda c: c["__items"])), lambda x: x["v"]).alias(name)))


def chunked_concat(df: DataFrame, keys: Sequence[str], value: str, number: str, name: str, sep: str = K.NAME_SEPARATOR,
                   size: int = CHUNK, rows_as: str | None = None, first: Mapping[str, Column] | None = None) -> DataFrame:
    """``ordered_concat`` for groups of any size: per group ``value`` joined with ``sep`` in the order of ``number``, each
    chunk joined by itself first.  Nulls are left out.

    In the same pass: ``rows_as`` names the number of rows of the group, ``first`` aggregates over rows numbered up to
    ``size`` (they see those rows only)."""
    first = first or {}
    rows = df.withColumn("__chunk", F.floor((F.col(number) - 1) / size).cast("bigint"))
    chunks = rows.groupBy(*keys, "__chunk").agg(ordered_concat(value, number, sep=sep).alias("__text"), F.count(F.lit(1)).alias("__rows"),
                                                *[c.alias(n) for n, c in first.items()])
    counted = [F.sum("__rows").alias(rows_as)] if rows_as else []
    return chunks.groupBy(*keys).agg(ordered_concat("__text", "__chunk", sep=sep).alias(name), *counted,
                                     *[F.max(F.when(F.col("__chunk") == 0, F.col(n))).alias(n) for n in first])


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, rn: str = "rn") -> DataFrame:
    """Rows ranked 1..n inside each group, with their rank in ``rn``.

    Written as a filter on ``row_number`` so the planner inserts a partial
    WindowGroupLimit before the shuffle: a hot group ships at most ``n`` rows per
    map task instead of all its rows."""
    return df.withColumn(rn, running_number(keys, order)).filter(F.col(rn) <= n)


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each group in ``order`` (arg-max with explicit ties)."""
    return top_n_per_group(df, keys, order, 1, rn="__rn").drop("__rn")


def first_per_key(df: DataFrame, key: str | Sequence[str], seq: str | Sequence = "row_seq") -> DataFrame:
    """Keep-first distinct: the earliest row (by ``seq``) of every key value."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [seq] if isinstance(seq, (str, Column)) else list(seq)
    return best_per_group(df, keys, order)


def nth_largest(value: str, rn: str, k: int) -> Column:
    """Aggregate: the value ranked ``k`` (NULL if the group has fewer rows)."""
    return F.max(F.when(F.col(rn) == k, F.col(value)))


def ordered_concat(value: str, rn: str, upto: int | None = None, sep: str = K.NAME_SEPARATOR) -> Column:
    """Aggregate: ``value`` joined with ``sep`` in ``rn`` order (optionally only rn <= upto)."""
    v = f"`{value}`" if upto is None else f"CASE WHEN `{rn}` <= {int(upto)} THEN `{value}` END"
    lit = "'" + sep.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(f"listagg({v}, {lit}) WITHIN GROUP (ORDER BY `{rn}`)")


def leaderboards(df: DataFrame, specs: Sequence[tuple], partitions: int | None = None, by: Sequence[str] | None = None) -> DataFrame:
    """Several independent places over one frame: ``specs`` = [(place, order, rank_if)].

    Each place is one range-partitioned, written copy (see ``leaderboard``); the next place starts from that copy.  ``by``:
    the columns that the orders use.  Then ``df`` is evaluated once (a range partitioning evaluates its input twice), only
    these columns go through the copies, and the places meet the other columns in one join on the row's number."""
    rows = df
    if by is not None:
        path = scratch_path(df.sparkSession, "unplaced")
        df.withColumn("__row", F.monotonically_increasing_id()).write.mode("errorifexists").parquet(path)
        rows = df.sparkSession.read.parquet(path)
    out = rows if by is None else rows.select("__row", *by)
    for place, order, rank_if in specs:
        out = leaderboard(out, order, place=place, partitions=partitions, rank_if=rank_if)
    places = [p for p, _, _ in reversed(specs)]
    if by is not None:
        out = rows.join(out.select("__row", *places), "__row")
    return out.select(*places, *[F.col(f"`{c}`") for c in df.columns])


def leaderboard(df: DataFrame, order: Sequence, place: str = "place", partitions: int | None = None,
                rank_if: Column | None = None) -> DataFrame:
    """Places 1..n after a global sort; ties get distinct places (``order`` must be total).

    One plan at every size, without a window over all rows: the rows are
    range-partitioned on the full sort key (Spark samples the key, so a hot
    first-key value is split by the later keys), sorted inside each partition and
    numbered locally.  That numbered copy is written once to the shared folder:
    the sampled boundaries are random per evaluation, so counts and numbers must
    come from the same copy (this also cuts the lineage).  The per-partition
    counts (one row per partition) become offsets that join back on the
    partition number.  ``rank_if``: only rows where it holds get a place (they
    must sort first in ``order``); the others get NULL."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = _order(order)
    cols = [F.col(f"`{c}`") for c in df.columns]
    ranged = (df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id())
              .withColumn("__ranked", F.lit(True) if rank_if is None else F.coalesce(rank_if, F.lit(False))))
    path = scratch_path(spark, "leaderboard")
    ranged.write.mode("errorifexists").parquet(path)
    fixed = spark.read.parquet(path)
    counts = fixed.filter(F.col("__ranked")).groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    pos = (F.coalesce(F.col("__off"), F.lit(0)) + local + F.lit(1)).cast("bigint")
    # at most one offset row per partition of the copy: a proven bound
    out = fixed.join(F.broadcast(offsets), "__pid", "left")
    return out.select(F.when(F.col("__ranked"), pos).alias(place), *cols)
