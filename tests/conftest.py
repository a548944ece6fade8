import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[4]").appName("podium-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "4g"))
    if not os.environ.get("PYSPARK_SUBMIT_ARGS", "").count("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="podium-test-ckpt-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="podium-test-")


RESULT_COLS = ["row_seq", "table_no", "player", "klass", "district", "score", "event_name", "date_text",
               "results_url", "m_skeet", "m_lane", "m_trap", "m_boar", "m_buck"]


def results_frame(spark, rows):
    """rows: dicts with any subset of RESULT_COLS."""
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("row_seq", T.LongType()), T.StructField("table_no", T.IntegerType()),
        T.StructField("player", T.StringType()), T.StructField("klass", T.StringType()),
        T.StructField("district", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("event_name", T.StringType()), T.StructField("date_text", T.StringType()),
        T.StructField("results_url", T.StringType()),
        *[T.StructField(m, T.DoubleType()) for m in ["m_skeet", "m_lane", "m_trap", "m_boar", "m_buck"]],
        T.StructField("venue", T.StringType()), T.StructField("season", T.StringType()),
    ])
    data = []
    for i, r in enumerate(rows):
        d = {"row_seq": i + 1, "table_no": 2, "klass": "", "district": "D", "event_name": "E",
             "date_text": "", "results_url": f"u/{i}", "venue": "", "season": ""}
        d.update(r)
        vals = []
        for f in schema.fields:
            v = d.get(f.name)
            if v is not None and isinstance(f.dataType, T.DoubleType):
                v = float(v)
            vals.append(v)
        data.append(tuple(vals))
    return spark.createDataFrame(data, schema)
