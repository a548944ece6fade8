"""Packing of tokenised documents into windows by non-negative least squares.

1. Every document is tokenised once.  Full windows are cut off its front; each is a sequence of its own.  What remains
   (fewer than ``window`` ids) is to be packed.  Only lengths and checksums are kept, no ids.
2. The histogram of the remainders' lengths has ``window`` bins, whatever the corpus.  Shallow combinations of lengths
   that fill a window exactly (pairs, triples and quadruples) are enumerated, and their repeat counts fitted to the
   histogram by non-negative least squares (coordinate descent over the sparse columns), then rounded down and
   trimmed so that no combination takes more of a length than there is.
3. A remainder's rank within its length tells which copy of which combination it fills.  Ranks are numbered within
   (length, salt) groups, whose count grows with the rows, plus the sum of the groups before.
4. What the rounded counts leave over is packed greedily: each such remainder is cut into pieces whose lengths are the
   powers of two of its length, longest first; pieces laid end to end by falling length never cross a window's end, and
   the last window is cut at powers of two, which need no padding.

Defined cases: null text counts as empty, an empty text is the end id alone; repeated rows are packed each; equal ids
are packed row by row; an empty table gives no rows.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.shared import Scratch, ship

WINDOW = 2048
END_ID = 1
CACHED = 800_000  # words and other runs without white space whose ids a task remembers
ROWS_PER_SALT = 100_000
#: Texts of these characters are encoded word by word: there Python's and the tokenizer's character tables agree.
PLAIN = re.compile("[\t\n\r\x20-\x7e\u00a1-\u017f\u2010-\u2027\u20ac]*")


def _class(kind: str) -> str:
    return "".join(c for c in map(chr, range(0xA1, 0x180)) if unicodedata.category(c)[0] == kind)


#: Fixed value: the vocabulary file's pre-tokenisation, for lower-case plain texts.
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_class('L')}]+|[0-9{_class('N')}]|[^\sa-z{_class('L')}0-9{_class('N')}]+")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others in
    turn from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class _Known(dict):
    """ids of runs without white space, kept up to a number of entries; then it starts anew.  A word is a run too."""

    def __init__(self, tokenizer):
        self.pieces, self.letters = tokenizer.model.tokenize, _byte_letters()

    def __missing__(self, run: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        words = [run] if run.isalpha() else SPLIT.findall(run)
        if len(words) == 1:
            word = run if run.isascii() else "".join([self.letters[b] for b in run.encode()])
            value = array("I", [t.id for t in self.pieces(word)]).tobytes()
        else:
            value = b"".join(map(self.__getitem__, words))
        self[run] = value
        return value


class Encoder:
    """ids of a text as little-endian unsigned 32-bit values.

    No id of the vocabulary spans white space or two words of its pre-tokenisation, so the ids of runs without white
    space, and of the words in them, are remembered.  A text with characters outside ``PLAIN`` goes through the
    tokenizer as a whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.runs = _Known(self.tokenizer)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text):
            return self.whole(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.runs.__getitem__, text.lower().split()))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for all tasks that a Python worker runs; what it remembers goes with each task."""
    return Encoder(path)


SUMMARY = "row long, id {kind}, n long, full array<long>, rest int, rest_crc long, bits array<long>"


def summarise(docs: DataFrame, id_col: str, text_col: str, path: str, window: int, end_id: int) -> DataFrame:
    """Per row: number of ids, checksums of the full windows, the remainder's length and checksum, and the checksums of
    its pieces when cut at the powers of two of its length."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        try:
            for rows in batches:
                out = []
                for row, i, text in zip(rows["row"], rows["id"], rows["text"]):
                    ids = encode(text) + end
                    n = len(ids) // 4
                    cut = n // window * window
                    view, rest = memoryview(ids), n - cut
                    full = [zlib.crc32(view[4 * a:4 * (a + window)]) for a in range(0, cut, window)]
                    bits, at = [], cut
                    for size in powers(rest):
                        bits.append(zlib.crc32(view[4 * at:4 * (at + size)]))
                        at += size
                    out.append((row, i, n, full, rest, zlib.crc32(view[4 * cut:]), bits))
                yield pd.DataFrame(out, columns=["row", "id", "n", "full", "rest", "rest_crc", "bits"]).astype({"id": rows["id"].dtype})
        finally:  # the worker goes on to tasks of other steps, which need the memory
            encode.runs.clear()
            rows = out = None
            pa.default_memory_pool().release_unused()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(run, SUMMARY.format(kind=kind))


def powers(n: int) -> list[int]:
    """The powers of two whose sum is n, longest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def combinations(window: int) -> list[tuple[int, ...]]:
    """Shallow fillings: every pair, and triples and quadruples that pair each length with equal or mirrored partners."""
    found = {tuple(sorted((a, window - a), reverse=True)) for a in range(1, window)}
    for a in range(1, window - 1):
        left = window - a
        for b in {left // 2, left // 3, left // 4, left * 2 // 5, left // 8, a}:
            if 0 < b < left:
                found.add(tuple(sorted((a, b, left - b), reverse=True)))
    for a in range(1, window - 2):
        b, left = divmod(window - a, 3)
        if b:
            found.add(tuple(sorted((a, b, b, b + left), reverse=True)))
    return sorted(found, reverse=True)


def solve(histogram: np.ndarray, combos: list[tuple[int, ...]], sweeps: int = 30) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|, by coordinate descent."""
    residual = histogram.astype(float).tolist()
    cells = [[(int(v), int(t)) for v, t in zip(*np.unique(c, return_counts=True))] for c in combos]
    norms = [float(sum(t * t for _, t in c)) for c in cells]
    x = [0.0] * len(combos)
    for _ in range(sweeps):
        moved = 0.0
        for j, c in enumerate(cells):
            step = sum(residual[v] * t for v, t in c) / norms[j]
            step = max(-x[j], step)
            if step:
                x[j] += step
                for v, t in c:
                    residual[v] -= step * t
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return np.array(x)


def rounded(x: np.ndarray, combos: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Whole counts that take no more of any length than the histogram has: largest fitted counts first, each length's
    rest then offered to the combinations again."""
    left = histogram.tolist()
    counts = [0] * len(combos)
    order = np.argsort(-x, kind="stable").tolist()
    cells = [[(int(v), int(t)) for v, t in zip(*np.unique(c, return_counts=True))] for c in combos]
    for wanted in (np.floor(x).tolist(), np.ceil(x).tolist(), None):
        for j in order:
            more = min(left[v] // t for v, t in cells[j])
            if wanted is not None:
                more = min(more, int(wanted[j]) - counts[j])
            if more > 0:
                counts[j] += more
                for v, t in cells[j]:
                    left[v] -= more * t
    return np.array(counts, np.int64)


class Plan:
    """Where the remainder of a given length and rank goes: streams of places, one for each part of each combination."""

    def __init__(self, combos: list[tuple[int, ...]], counts: np.ndarray):
        self.sequences = int(counts.sum())
        streams: dict[int, list[tuple[int, int, int]]] = {}
        base = 0
        for c, n in zip(combos, counts.tolist()):
            if n:
                offset = 0
                for part in c:
                    streams.setdefault(part, []).append((n, base, offset))
                    offset += part
                base += n
        self.streams = {part: tuple(np.array(v, np.int64) for v in zip(*s)) for part, s in streams.items()}
        self.ends = {part: np.cumsum(s[0]) for part, s in self.streams.items()}

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset), both -1 where the plan has no place left."""
        sequence, offset = np.full(len(lengths), -1, np.int64), np.full(len(lengths), -1, np.int64)
        for part in np.unique(lengths):
            if part in self.ends:
                at = np.flatnonzero(lengths == part)
                ends, (n, base, off) = self.ends[part], self.streams[part]
                s = np.searchsorted(ends, ranks[at], "right")
                ok = s < len(ends)
                at, s = at[ok], s[ok]
                sequence[at] = base[s] + ranks[at] - (ends[s] - n[s])
                offset[at] = off[s]
        return sequence, offset


def _running(groups: DataFrame, rows: int, key: str) -> DataFrame:
    """``before``: the sum of ``count`` over the smaller salts of the same key."""
    return groups.withColumn("before", F.coalesce(F.sum("count").over(
        Window.partitionBy(key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    ship(docs.sparkSession)
    tmp = Scratch(docs.sparkSession, "packing")
    rows = tmp.write(summarise(docs, id_col, text_col, path or vocabulary(), window, end_id))
    about = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("full")).alias("full")).first()
    salts = about["rows"] // ROWS_PER_SALT + 8
    rest = rows.where("rest > 0").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))

    bins = rest.groupBy("rest", "salt").count()
    histogram = np.zeros(window, np.int64)
    for r in bins.groupBy("rest").agg(F.sum("count").alias("n")).collect():  # window rows at most
        histogram[r["rest"]] = r["n"]
    combos = combinations(window)
    plan = Plan(combos, rounded(solve(histogram, combos), combos, histogram))

    before = _running(bins, salts, "rest").select("rest", "salt", "before")
    ranked = (rest.withColumn("own", F.row_number().over(Window.partitionBy("rest", "salt").orderBy("row")) - 1)
              .join(before, ["rest", "salt"])
              .select("row", "id", "n", "rest", "rest_crc", "bits", "salt", (F.col("own") + F.col("before")).alias("rank")))

    @F.pandas_udf("sequence long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence": sequence, "offset": offset})

    placed = tmp.write(ranked.withColumn("at", place("rest", "rank")))
    whole = placed.where("at.sequence >= 0").select(
        "id", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").cast("long").alias("length"),
        F.col("rest_crc").alias("crc"), "n", F.col("at.sequence").alias("sequence"), F.col("at.offset").alias("offset"))

    # what the plan leaves over: pieces of 2^k ids, numbered by falling size
    sizes = F.filter(F.transform(F.sequence(F.lit(window.bit_length() - 1), F.lit(0)), lambda b: F.pow(F.lit(2), b).cast("int")),
                     lambda p: F.col("rest").bitwiseAND(p) != 0)
    pieces = (placed.where("at.sequence < 0")
              .select("id", "row", "n", "rest", "salt", F.posexplode(F.arrays_zip(sizes.alias("size"), F.col("bits").alias("crc"))).alias("k", "p"))
              .select("id", "row", "n", "salt", F.col("p.size").alias("size"), F.col("p.crc").alias("crc"),
                      # the larger powers of the remainder lie before this one
                      (F.col("n") - F.col("rest") + F.col("rest") - F.pmod(F.col("rest"), 2 * F.col("p.size"))).alias("start")))
    per = tmp.write(pieces.groupBy("size", "salt").count())
    total = {r["size"]: r["n"] for r in per.groupBy("size").agg(F.sum("count").alias("n")).collect()}
    base, front = 0, {}
    for size in sorted(total, reverse=True):
        front[size] = base
        base += size * total[size]
    cut = base // window * window
    tail = powers(base - cut)
    ends = np.cumsum([0, *tail]).tolist()
    fronts = F.create_map(*(F.lit(x) for kv in (front or {0: 0}).items() for x in kv))
    position = (F.element_at(fronts, F.col("size")).cast("long") + (F.col("own") + F.col("before")) * F.col("size"))
    loose = (pieces.withColumn("own", F.row_number().over(Window.partitionBy("size", "salt").orderBy("row")) - 1)
             .join(_running(per, salts, "size").select("size", "salt", "before"), ["size", "salt"])
             .withColumn("position", position))
    # the last, short window falls apart into sequences of 2^k ids
    in_tail = F.col("position") >= cut
    step = F.lit(0)
    start_of = F.lit(cut)
    for k, e in enumerate(ends[:-1]):
        step = F.when(F.col("position") >= cut + e, k).otherwise(step)
        start_of = F.when(F.col("position") >= cut + e, cut + e).otherwise(start_of)
    full_before = plan.sequences
    loose = loose.select(
        "id", "start", F.col("size").cast("long").alias("length"), "crc", "n",
        (full_before + F.when(in_tail, cut // window + step).otherwise(F.floor(F.col("position") / window))).alias("sequence"),
        F.when(in_tail, F.col("position") - start_of).otherwise(F.pmod("position", F.lit(window))).alias("offset"))

    # full windows: a sequence each, numbered by salt
    first = full_before + cut // window + len(tail)
    long_rows = rows.where(F.size("full") > 0).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    per_salt = tmp.write(long_rows.groupBy("salt").agg(F.sum(F.size("full")).alias("count")).withColumn("all", F.lit(0)))
    own = F.sum(F.size("full")).over(Window.partitionBy("salt").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    full = (long_rows.withColumn("own", F.coalesce(own, F.lit(0)))
            .join(_running(per_salt, salts, "all").select("salt", "before"), "salt")
            .select("id", "n", (F.col("own") + F.col("before")).alias("base"), F.posexplode("full").alias("k", "crc"))
            .select("id", (F.col("k").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "crc", "n",
                    (first + F.col("base") + F.col("k")).alias("sequence"), F.lit(0).cast("long").alias("offset")))
    out = whole.unionByName(loose).unionByName(full)
    return out.select(F.col("id").alias(id_col), F.col("start").cast("long").alias("start"), "length",
                      F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
                      F.col("sequence").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))
