"""The pipeline's stages against brute force on a small corpus, and the registered queries' contracts."""

import random

import corpus_pipeline
import __spark_entry__ as entry
from podium.llm import packing, quality, queries

from test_llm_operators import contaminated_expected, exact_expected, near_expected


def words(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_stages(spark, tmp_path):
    rng = random.Random(21)
    bench = [(i, words(rng, 30)) for i in range(4)]
    rows, labels = [], []
    for i in range(300):
        text = ". ".join(words(rng, 12).capitalize() for _ in range(6)) + "."
        bad = i % 4 == 0
        if bad:
            text = text.replace(" ", " | ")
        labels.append((i, int(not bad), 0))
        if i % 10 == 3:
            text += " " + bench[i % 4][1]
        rows.append((i, text))
    rows += [(1000 + i, rows[i][1].upper() if i % 2 else rows[i][1]) for i in range(1, 40)]
    rows += [(2000 + i, rows[i][1] + " tail") for i in range(1, 40)]
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    first = spark.read.parquet(f"{folder}/documents.parquet")
    docs, before = first, sorted(rows)
    field = quality.train(first, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r.doc_id for r in quality.score(first, field).collect() if r.predicted}
    rules = [lambda now: good, lambda now: {r[0] for r in exact_expected(now) if r[3]}, lambda now: {r[0] for r in near_expected(now, 5) if r[3]},
             lambda now: {r[0] for r in contaminated_expected(now, bench) if not r[5]}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == first.columns, name
        out.write.parquet(f"{folder}/out{k}")
        docs = spark.read.parquet(f"{folder}/out{k}")
        kept = rules[k](before)
        before = [r for r in before if r[0] in kept]
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == before, name
        assert 0 < len(before)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {r[0] for r in before}
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, packed.collect()))


def odd_rows(spark, rows):
    """Documents whose other columns have the names that the stages use inside."""
    return spark.createDataFrame([(i, t, "r", 5, "n", "f", 1, 2, "k", 9) for i, t in rows],
                                 "doc_id long, text string, row string, id long, name string, found string, podium_row int, PODIUM_ROW_ int, text_sha256 string, component int")


def test_stages_with_odd_rows_and_clashing_columns(spark, tmp_path):
    rng = random.Random(8)
    passage, far, long = words(rng, 30), words(rng, 40), words(rng, 50_000, 9000)
    spark.createDataFrame([(1, passage), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, None), (1, ""), (1, "  "), (2, far), (2, far.upper()), (None, far), (3, long), (4, long + " tail"), (4, passage), (None, passage), (5, "é"), (6, "É")]
    docs = odd_rows(spark, rows)

    def kept(k, df):
        out = corpus_pipeline.STAGES[k][1](spark, df, str(tmp_path))
        assert out.columns == df.columns
        return out, sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    exact, got = kept(1, docs)
    fold = [(i, (t or "").upper() if (t or "").isascii() else t) for i, t in got]
    assert sorted(fold, key=str) == sorted([(1, ""), (1, "  "), (2, far.upper()), (3, long.upper()), (4, (long + " tail").upper()), (4, passage.upper()),
                                            (5, "é"), (6, "É")], key=str)
    _, got = kept(2, docs)
    assert got == sorted([(None, None), (1, ""), (1, "  "), next(r for r in got if r[1] and r[1].upper() == far.upper()), (3, long), (4, passage), (5, "é"), (6, "É")], key=str)
    assert kept(3, docs)[1] == sorted([r for r in rows if r[1] != passage], key=str)
    none = odd_rows(spark, [])
    for k in (1, 2, 3):
        assert kept(k, none)[1] == []
    assert corpus_pipeline.STAGES[4][1](spark, none, str(tmp_path)).count() == 0


def test_registered():
    names = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names) and len(queries.QUERIES) == 13
    assert set(queries.ORACLE) <= set(queries.QUERIES) and "pipeline" not in entry.oracle_sql()


def test_a_stage_leaves_only_its_result(spark, tmp_path, monkeypatch):
    from pathlib import Path
    from podium.llm.shared import shared_folder
    spark.createDataFrame([(i, f"text {i % 3}") for i in range(9)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("exact dedup", corpus_pipeline.exact_stage), ("again", corpus_pipeline.exact_stage)])
    root = Path(shared_folder(spark).removeprefix("file:")) / f"podium-llm-{spark.sparkContext.applicationId}"
    before = {p.name for p in root.glob("*")}
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [6, 7, 8]
    new = [p for p in root.glob("*") if p.name not in before and any(p.iterdir())]
    assert [p.name.split("-")[0] for p in new] == ["pipeline"] and len(list(new[0].iterdir())) == 1


def test_packing_leaves_nothing_in_the_workers(spark):
    """A Python worker goes on to other stages: what a packing task remembered must be gone."""
    import pandas as pd

    path = packing.vocabulary()
    docs = spark.createDataFrame([(i, f"word{i} and some others") for i in range(200)], "doc_id long, text string")
    assert packing.pack(docs).count() >= 200

    def remembered(batches):
        for rows in batches:
            yield pd.DataFrame({"n": [len(packing.encoder(path).runs)] * len(rows)})

    left = spark.range(0, 64, 1, 16).mapInPandas(remembered, "n long").collect()
    assert {r.n for r in left} == {0}
