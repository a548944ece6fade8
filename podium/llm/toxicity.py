"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Two lexicons serve: a fixed one of insults in common use, and one learned from a part of the labelled sample: words
found between at least three different pairs of words in toxic documents (copies of one document count once so) and
rarely in others, weighted by their log-odds.  Tasks turn each whole text into a row of densities: hits of either lexicon (plain,
disguised by look-alike signs or spread letters, near a second-person word), distinct hits, second-person words,
capitals, punctuation, obfuscated words, and the densest passage of 20 words wherever it stands.  Trees are boosted by Spark's ``GBTClassifier`` on a second part of the sample,
so that the learned words are judged on documents they were not learned from; an isotonic curve fitted on a third part
maps the raw score to a probability.

``sample_docs`` bounds the sample and ``LEARNED`` the learned words; scoring reads every text.  Defined cases: null counts as empty; empty texts get a
score like any other; without labels of both classes the score is the smoothed share of the class seen (0.5 without
labels); repeated rows are scored each.  Labels, language, source and id never enter a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.labelled import remainder, sample
from podium.llm.shared import Scratch, ship

SAMPLE_DOCS = 16_000
LEARNED, SUPPORT = 2_000, 3
MOD, HELD_OUT, THRESHOLD = 3, 1, 0.7
TREES, DEPTH, RATE = 12, 3, 0.3

#: Insults in common use, in the corpus's languages; a parameter of ``features``.
LEXICON = frozenset("""
idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown fool imbecile
jerk bastard vermin filth freak retard retarded coward pig swine bitch whore slut shit crap asshole fuck fucking damn
cretin dimwit halfwit nitwit scumbag lowlife parasite degenerate hate kill ugly
dumm dummkopf trottel vollidiot abschaum wertlos widerlich arschloch scheisse dreckig versager schwachkopf
connard connasse salaud ordure crétin débile minable dégoûtant merde pourriture abruti
estúpido estúpida imbécil basura patético asqueroso payaso escoria mierda cabrón inútil perdedor
""".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tus usted vosotros".split())
#: Signs that stand for letters in disguised words.
LOOKALIKE = str.maketrans("013457@$!|", "oieastasii")
NAMES = ["learned_sum", "learned_max", "learned_hits", "learned_share", "hits", "log_hits", "share", "distinct", "disguised", "aimed", "second", "capitals", "shouted", "marks", "signs", "obfuscated", "peak", "log_words"]

_TOKEN = re.compile(r"[^\s]+")
_WORD = re.compile(r"\w+", re.UNICODE)
_DISGUISE = re.compile(r"(?=\S*[^\W\d_])(?=\S*[0-9@$!|*])\S{4,}")
_SPREAD = re.compile(r"(?<!\w)(?:\w[ .\-*_]){3,}\w(?!\w)")


def learn(rows: DataFrame) -> dict[str, float]:
    """Words with their log-odds of standing in a toxic document, from rows (label, text); ``LEARNED`` at most."""
    tmp = Scratch(rows.sparkSession, "lexicon")
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    rows = tmp.write(rows.select("label", words.alias("words")))
    n = F.size("words")
    rest = F.greatest(n - 1, F.lit(0))
    places = F.arrays_zip(F.concat(F.array(F.lit("")), F.slice("words", 1, rest)).alias("before"), F.col("words").alias("word"),
                          F.concat(F.slice("words", 2, rest), F.array(F.lit(""))).alias("after"))
    toxic = rows.where("label = 1 and size(words) > 0").select(F.explode(places).alias("p")).select("p.word", "p.before", "p.after").distinct()
    often = tmp.write(toxic.groupBy("word").count().where(F.col("count") >= SUPPORT).select("word"))
    count = lambda label: F.count(F.when(F.col("label") == label, 1))
    seen = (rows.select("label", F.explode(F.array_distinct("words")).alias("word")).join(often, "word")
            .groupBy("word").agg(count(1.0).alias("toxic"), count(0.0).alias("clean")))
    total = rows.agg(count(1.0).alias("toxic"), count(0.0).alias("clean")).first()
    odds = F.log((F.col("toxic") + 0.1) / (F.col("clean") + 0.9)) - float(np.log((total["toxic"] + 0.1) / (total["clean"] + 0.9)))
    best = (seen.where((F.col("toxic") >= SUPPORT) & (F.col("toxic") >= 4 * F.col("clean")))
            .select("word", odds.alias("odds")).orderBy(F.desc("odds"), "word").limit(LEARNED))
    return {r["word"]: r["odds"] for r in best.collect()}


def features(text: str, learned: dict[str, float], lexicon: frozenset[str] = LEXICON) -> list[float]:
    """The values named in ``NAMES``."""
    low = text.lower()
    words = _WORD.findall(low)
    n = max(len(words), 1)
    weights = [learned[w] for w in words if w in learned]
    at = [i for i, w in enumerate(words) if w in lexicon]
    second = [w in SECOND_PERSON for w in words] if at or len(words) < 200 else ()
    odd = 0
    disguised = 0
    if re.search(r"[0-9@$!|*]", low):
        for token in _DISGUISE.findall(low):
            plain = re.sub(r"[^\w]", "", token.strip("!?.,;:*$%&#").translate(LOOKALIKE))
            odd += 1
            disguised += plain in lexicon and token.strip("!?.,;:*$%&#|") not in lexicon
    for token in _SPREAD.findall(low):
        disguised += re.sub(r"[ .\-*_]", "", token) in lexicon
    aimed = sum(any(second[max(0, i - 4):i + 5]) for i in at) if second else 0
    peak = end = 0
    for k, i in enumerate(at):
        while end < len(at) and at[end] < i + 20:
            end += 1
        peak = max(peak, end - k)
    size = max(len(text), 1)
    letters = max(sum(map(str.isalpha, text)) if not text.isascii() else len(re.sub(r"[^A-Za-z]+", "", text)), 1)
    upper = len(re.sub(r"[^A-Z]+", "", text))
    shouted = sum(1 for w in _TOKEN.findall(text) if len(w) > 2 and w.isupper())
    return [sum(weights), max(weights, default=0.0), float(len(weights)), len(weights) / n,
            float(len(at)), float(np.log1p(len(at))), len(at) / n, float(len({words[i] for i in at})), float(disguised), aimed / n,
            (sum(second) if second else sum(w in SECOND_PERSON for w in words)) / n, upper / letters, shouted / n,
            (text.count("!") + text.count("?")) / size, sum(map(text.count, "#$%&*@")) / size, odd / n, float(peak),
            float(np.log1p(len(words)))]


def measured(docs: DataFrame, keep: str, kind: str, learned: dict[str, float]) -> DataFrame:
    """The column ``keep`` and the features of ``text`` as a vector."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({keep: rows[keep], "x": [features(t, learned) for t in rows["text"]]})

    return docs.mapInPandas(run, f"{keep} {kind}, x array<double>").select(keep, array_to_vector("x").alias("features"))


class Scorer:
    """The fitted trees and curve; ``prior`` alone where there was nothing to learn from."""

    def __init__(self, prior: float, learned: dict[str, float] | None = None, trees=None, curve=None):
        self.prior, self.learned, self.trees, self.curve = prior, learned or {}, trees, curve

    def add_score(self, rows: DataFrame) -> DataFrame:
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.prior))
        raw = self.trees.transform(rows).withColumn("raw", vector_to_array("rawPrediction")[1])
        out = VectorAssembler(inputCols=["raw"], outputCol="raw_vector").transform(raw)
        return self.curve.transform(out).withColumn("score", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Scorer:
    tmp = Scratch(docs.sparkSession, "toxicity")
    texts = tmp.write(sample(docs, labels, "toxic", MOD, HELD_OUT, sample_docs).withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(5))))
    learned = learn(texts.where("fold < 3").select("label", "text"))
    rows = tmp.write(measured(texts.where("fold >= 3").select("label", "text"), "label", "double", learned)
                     .withColumn("fold", F.pmod(F.xxhash64(vector_to_array("features")), F.lit(4))))
    # a few thousand short rows: one partition keeps the fit independent of the task layout
    seen = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n = sum(seen.values())
    prior = float((seen.get(1.0, 0) + 1) / (n + 2))
    if len(seen) < 2:
        return Scorer(prior)
    ordered = rows.coalesce(1).sortWithinPartitions("label", vector_to_array("features"))
    fit, rest = ordered.where("fold > 0"), ordered.where("fold = 0")
    if fit.select("label").distinct().count() < 2 or rest.select("label").distinct().count() < 2:
        fit = rest = ordered
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=7, maxBins=32,
                          minInstancesPerNode=10).fit(fit)
    held = trees.transform(rest).withColumn("raw", vector_to_array("rawPrediction")[1])
    held = VectorAssembler(inputCols=["raw"], outputCol="raw_vector").transform(held).select("label", "raw_vector")
    curve = IsotonicRegression(featuresCol="raw_vector", labelCol="label", predictionCol="calibrated").fit(held)
    tmp.drop(texts)
    return Scorer(prior, learned, trees, curve)


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id") -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = scorer.add_score(measured(texts, "id", kind, scorer.learned))
    return out.select(F.col("id").alias(id_col), F.coalesce(remainder(F.col("id"), MOD) == HELD_OUT, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
