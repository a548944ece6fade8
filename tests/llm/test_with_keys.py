"""Rows are picked by their keys without being moved."""

import io
from contextlib import redirect_stdout

from podium.llm import decontaminate, exact_dedup, near_dedup
from podium.llm.shared import with_keys

TEXTS = ["one two three four five six seven", "ONE two three four five six seven", "eight nine ten eleven twelve thirteen", "", None]


def test_keys_over_many_partitions(spark):
    from pyspark.sql import functions as F
    rows = spark.range(0, 100_000, 1, 3).select(F.monotonically_increasing_id().alias("k"), F.col("id").alias("v"))
    keys = rows.where("v % 7 = 0 OR v = 99999").select("k")
    want = {v for v in range(100_000) if v % 7 == 0 or v == 99999}
    assert sorted(r.v for r in with_keys(rows, "k", keys).collect()) == sorted(want)
    assert sorted(r.v for r in with_keys(rows, "k", keys, kept=False).collect()) == sorted(set(range(100_000)) - want)
    assert with_keys(rows, "k", keys.limit(0)).isEmpty()
    assert with_keys(rows, "k", keys.limit(0), kept=False).count() == 100_000
    assert with_keys(rows, "k", keys).columns == ["k", "v"]


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_stages_do_not_shuffle_texts_for_what_stays(spark):
    """Above the broadcast limit the last join of a stage dealt all whole texts out again."""
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS * 3)], "doc_id long, text string, lang string")
    items = spark.createDataFrame([("q", TEXTS[0])], "item_id string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out, left in ((exact_dedup.keep_one(docs), 3), (near_dedup.keep_one(docs), 8), (decontaminate.keep_clean(docs, items), 9)):
            assert out.count() == left and out.columns == docs.columns
            assert "SortMergeJoin" not in _plan(out) and "ShuffledHashJoin" not in _plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
