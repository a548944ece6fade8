"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line gets features of its own and of its neighbours; a chain of two states (bad, good) joins them.  The field is
trained on a bounded sample of labelled documents, whose lines all take their document's label, by gradient ascent of
the conditional log-likelihood.  A document's raw score is the mean of its lines' forward-backward marginals of "good",
weighted by their length; a logistic curve fitted on the same sample calibrates it to a probability.

Parameters that bound the training: ``sample_docs`` documents, of which those with more than ``sample_lines`` lines are
left out.  Scoring reads every line of every text.

Defined cases: null counts as empty; an empty text is one empty line and gets a score like any other; documents without
any label to learn from all get the score 0.5 (one class only: that class's share, smoothed); repeated rows are scored
each.  Labels, language, source and id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.labelled import remainder, sample
from podium.llm.shared import ship

SAMPLE_DOCS, SAMPLE_LINES = 3000, 400
MOD, HELD_OUT, THRESHOLD = 5, 0, 0.3
CHUNK_CHARS = 2_000_000  # characters whose lines are measured at a time
MARKS = "|#$%&*!"
N_OWN = 12 + len(MARKS)
FEW = 12  # characters

_CLASSES = np.zeros(0x500, np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 sentence mark, 6 symbol, 7.. MARKS
for _c in range(0x500):
    _s = chr(_c)
    _CLASSES[_c] = (1 if _s.islower() else 2 if _s.isupper() else 3 if _s.isdigit() else 4 if _s.isspace()
                    else 7 + MARKS.index(_s) if _s in MARKS else 5 if _s in ".,;:?'\"-()" else 0 if _s.isalpha() else 6)


def line_features(lines: list[str], firsts: np.ndarray | None = None) -> np.ndarray:
    """One row of ``N_OWN`` values per line, from the whole line.  ``firsts``: where documents begin (one, if none)."""
    n = len(lines)
    counts = np.zeros((n, 7 + len(MARKS)), np.float64)
    at = 0
    while at < n:
        end, size = at, 0
        while end < n and (end == at or size + len(lines[end]) <= CHUNK_CHARS):
            size += len(lines[end])
            end += 1
        codes = np.frombuffer("".join(lines[at:end]).encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = np.where(codes < len(_CLASSES), _CLASSES[np.minimum(codes, len(_CLASSES) - 1)], 0)
        owner = np.repeat(np.arange(end - at), [len(x) for x in lines[at:end]])
        counts[at:end] = np.bincount(owner * counts.shape[1] + kinds, minlength=(end - at) * counts.shape[1]).reshape(end - at, -1)
        at = end
    length = np.array([len(x) for x in lines], float)
    nw, distinct, same = np.empty(n), np.empty(n), np.empty(n)
    for i, x in enumerate(lines):
        w = x.split()
        nw[i], distinct[i], same[i] = len(w), len(set(w)), sum(map(eq, w, w[1:]))
    # shares are drawn towards zero in short lines, where one sign says little
    some, letters = length + FEW, counts[:, 1] + counts[:, 2] + counts[:, 0] + FEW
    before = [None, *lines[:-1]]
    out = np.empty((n, N_OWN))
    out[:, 0] = 1
    out[:, 1] = np.log1p(length) / 5
    out[:, 2] = counts[:, 2] / letters
    out[:, 3] = counts[:, 3] / some
    out[:, 4] = (nw - distinct) / (nw + 2)
    out[:, 5] = same / (nw + 2)
    out[:, 6] = np.minimum((length - nw) / np.maximum(nw, 1) / 10, 3)
    out[:, 7] = [x.rstrip()[-1:] in (".", "!", "?", "…") for x in lines]
    out[:, 8] = [x == y for x, y in zip(lines, before)]
    out[0 if firsts is None else firsts, 8] = 0
    out[:, 9] = counts[:, 5] / some
    out[:, 10] = counts[:, 6] / some
    out[:, 11] = length == 0
    out[:, 12:] = np.sqrt(counts[:, 7:] / some[:, None])
    return out


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Own features, then those of the line before and after (zeros at the ends)."""
    out = np.zeros((len(own), 3 * own.shape[1]))
    k = own.shape[1]
    out[:, :k] = own
    out[1:, k:2 * k] = own[:-1]
    out[:-1, 2 * k:] = own[1:]
    return out


def marginals(emit: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains.  ``emit``: (chains, steps) log-odds of "good".

    Returns P(good) per step, the expected transition counts per chain and the log normaliser."""
    b, steps = emit.shape
    pot = np.stack([np.zeros_like(emit), emit], 2)
    alpha = np.empty((b, steps, 2))
    alpha[:, 0] = pot[:, 0]
    for t in range(1, steps):
        x = alpha[:, t - 1, :, None] + trans
        alpha[:, t] = np.logaddexp(x[:, 0], x[:, 1]) + pot[:, t]
    beta = np.zeros((b, steps, 2))
    for t in range(steps - 2, -1, -1):
        x = trans + (pot[:, t + 1] + beta[:, t + 1])[:, None, :]
        inside = (t + 1 < lengths)[:, None]
        beta[:, t] = np.where(inside, np.logaddexp(x[:, :, 0], x[:, :, 1]), 0)
    last = alpha[np.arange(b), lengths - 1]
    logz = np.logaddexp(last[:, 0], last[:, 1])
    post = alpha + beta - logz[:, None, None]
    good = np.exp(np.minimum(post[:, :, 1], 0))
    pairs = np.zeros((b, 2, 2))
    if steps > 1:
        joint = alpha[:, :-1, :, None] + trans + (pot[:, 1:] + beta[:, 1:])[:, :, None, :] - logz[:, None, None, None]
        inside = (np.arange(1, steps)[None, :] < lengths[:, None])[:, :, None, None]
        pairs = np.where(inside, np.exp(np.minimum(joint, 0)), 0).sum(1)
    return good, pairs, logz


def _chains(lengths: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Chains of like length together, with at most ``size`` steps in a padded block (one chain at least)."""
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * lengths[order[end]] <= size:
            end += 1
        yield order[at:end]
        at = end


class Field:
    """Weights of the chain, the features' scale and the calibration curve."""

    def __init__(self, prior: float):
        self.prior, self.weights = prior, None

    def fit(self, features: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 0.08, decay: float = 1e-4) -> None:
        x = np.concatenate(features)
        self.mean, self.scale = x.mean(0), x.std(0)
        constant = self.scale < 1e-9
        self.mean[constant], self.scale[constant] = 0, 1
        lengths = np.array([len(f) for f in features])
        blocks = []
        for chains in _chains(lengths, 40_000):
            steps = lengths[chains].max()
            pad = np.zeros((len(chains), steps, x.shape[1]))
            for i, c in enumerate(chains):
                pad[i, :lengths[c]] = (features[c] - self.mean) / self.scale
            blocks.append((pad, lengths[chains], labels[chains]))
        w, trans = np.zeros(x.shape[1] + 1), np.zeros((2, 2))
        m, v = np.zeros(w.size + 4), np.zeros(w.size + 4)
        total = lengths.sum()
        # both classes weigh the same in lines
        lines = np.array([lengths[labels == 0].sum(), lengths[labels == 1].sum()], float)
        weight = total / 2 / np.maximum(lines, 1)
        for k in range(1, rounds + 1):
            grad = np.zeros(w.size + 4)
            for pad, n, y in blocks:
                good, pairs, _ = marginals(pad @ w[:-1] + w[-1], trans, n)
                inside = np.arange(pad.shape[1])[None, :] < n[:, None]
                cost = weight[y.astype(int)]
                miss = np.where(inside, y[:, None] - good, 0) * cost[:, None]
                grad[:w.size - 1] += np.einsum("bt,btf->f", miss, pad)
                grad[w.size - 1] += miss.sum()
                seen = np.zeros_like(pairs)
                seen[np.arange(len(y)), y.astype(int), y.astype(int)] = n - 1
                grad[w.size:] += ((seen - pairs) * cost[:, None, None]).sum(0).ravel()
            grad = grad / total - decay * np.concatenate([w, trans.ravel()])
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
            w += step[:w.size]
            trans += step[w.size:].reshape(2, 2)
        self.weights, self.trans = w, np.clip(trans, -3, 3)

    def raw(self, features: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """Length-weighted mean of the lines' marginals."""
        lengths = np.array([len(f) for f in features])
        out = np.empty(len(features))
        for chains in _chains(lengths, 200_000):
            steps = lengths[chains].max()
            emit = np.zeros((len(chains), steps))
            for i, c in enumerate(chains):
                emit[i, :lengths[c]] = ((features[c] - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
            good, _, _ = marginals(emit, self.trans, lengths[chains])
            for i, c in enumerate(chains):
                out[c] = np.average(good[i, :lengths[c]], weights=sizes[c] + 1.0)
        return out

    def calibrate(self, raw: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve over the raw score by Newton steps, slightly regularised."""
        x = np.stack([raw, np.ones_like(raw)], 1)
        c = np.zeros(2)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
            c += np.linalg.solve(h, x.T @ (labels - p) - 1e-2 * c)
        self.curve = c if c[0] > 0 else np.array([0.0, float(np.log(self.prior / (1 - self.prior)))])

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        out, at = np.empty(len(texts)), 0
        while at < len(texts):  # so many characters at a time, one text at least
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK_CHARS):
                size += len(texts[end])
                end += 1
            out[at:end] = self._score(texts[at:end])
            at = end
        return out

    def _score(self, texts: list[str]) -> np.ndarray:
        lines = [t.split("\n") for t in texts]
        ends = np.cumsum([len(ls) for ls in lines])[:-1]
        own = line_features([x for ls in lines for x in ls], np.r_[0, ends])
        sizes = np.split(np.array([float(len(x)) for ls in lines for x in ls]), ends)
        raw = self.raw([with_neighbours(f) for f in np.split(own, ends)], sizes)
        return 1 / (1 + np.exp(-np.clip(raw * self.curve[0] + self.curve[1], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Field:
    """Features of the sample are made by tasks; the driver gets them, ``sample_docs * sample_lines`` rows at most."""

    ship(docs.sparkSession)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for label, text in zip(rows["label"], rows["text"]):
                lines = text.split("\n")
                if len(lines) <= sample_lines:
                    out.append((label, [len(x) for x in lines], line_features(lines).astype("<f4").tobytes()))
            yield pd.DataFrame(out, columns=["label", "sizes", "x"])

    rows = (sample(docs, labels, "quality", MOD, HELD_OUT, sample_docs)
            .mapInPandas(measure, "label double, sizes array<long>, x binary").collect())
    rows.sort(key=lambda r: (r["label"], r["x"], r["sizes"]))  # the result doesn't depend on the order of tasks
    y = np.array([r["label"] > 0 for r in rows], float)
    field = Field(float((y.sum() + 1) / (len(y) + 2)))
    if 0 < y.sum() < len(y):
        features = [with_neighbours(np.frombuffer(r["x"], "<f4").reshape(-1, N_OWN).astype(float)) for r in rows]
        field.fit(features, y)
        field.calibrate(field.raw(features, [np.array(r["sizes"], float) for r in rows]), y)
    return field


def score(docs: DataFrame, field: Field, id_col: str = "doc_id") -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"id": rows["id"], "score": field.score(list(rows["text"]))})

    kind = docs.schema[id_col].dataType.simpleString()
    out = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
           .mapInPandas(run, f"id {kind}, score double"))
    return out.select(F.col("id").alias(id_col), F.coalesce(remainder(F.col("id"), MOD) == HELD_OUT, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold, with the columns they came with; judged where they lie, so
    nothing is shuffled."""
    field = train(docs, labels)

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series(field.score(list(texts)))

    return docs.where(judge(F.coalesce(F.col("text"), F.lit(""))) >= THRESHOLD)
