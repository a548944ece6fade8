"""The tolerant number rule against pandas' to_numeric(errors='coerce') on many
generated strings (infinities excepted: they are rejected here by design)."""

import math
import random

import pandas as pd
from pyspark.sql import functions as F

from podium.functions import coerce_number


def _texts(n: int, seed: int = 5) -> list[str]:
    rnd = random.Random(seed)
    atoms = ["1", "12", "435", "0", "007", ".", "e", "E", "+", "-", " ", ",", "_", "x", "d", "f", "inf", "nan", "5"]
    return ["".join(rnd.choice(atoms) for _ in range(rnd.randint(1, 5))) for _ in range(n)]


def test_coerce_matches_pandas(spark):
    texts = _texts(2000)
    expected = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce").tolist()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", coerce_number(F.col("t")).alias("v")).collect()}
    bad = []
    for i, t in enumerate(texts):
        e = expected[i]
        e = None if (e is None or (isinstance(e, float) and not math.isfinite(e))) else float(e)
        if got[i] != e:
            bad.append((t, got[i], e))
    assert not bad, bad[:10]
