"""Document fingerprints by content-defined chunking.

A gear hash over the code points (each step doubles the hash and adds the code point's own random number, in 16 bits, so
that it knows the last sixteen) proposes cuts.  Cutting is normalised: between ``LEAST`` and ``NORMAL`` code points a
cut needs ``HARD`` zero bits, from there to ``MOST`` only ``EASY`` ones, and ends there at the latest; sizes so stay
near the normal one.  Hash and cuts depend on nearby text only: after an insertion or a removal the cuts fall into step again.

A fingerprint is the set of the chunks' digests, each weighted by the code points that its occurrences cover, written
``digest:weight`` in the order of digests.  The share of one fingerprint's weight that another one covers too
(``contained``) estimates how much of the one text stands in the other, wherever it stands there.

``with_next`` compares each document with its successor in descending order of ids, and with an edited version of itself
whose last half is the successor's beginning.  Rows are dealt once, into ranges of ids with bounds from approximate
quantiles; the first row of each range goes along to the range before it, so no task needs another one's rows and none
holds more than two texts at a time beyond its Arrow batch.

Defined cases: null texts count as empty; an empty text has an empty fingerprint, which is contained fully in any other, and
contains nothing of a text; equal texts have equal fingerprints.  Rows of equal ids follow each other by a hash of
the text, then by the text; null ids come last; a single row is its own successor; an empty table gives no rows.  Ids must be
integers.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.shared import ship

LEAST, NORMAL, MOST = 8, 24, 128
HARD, EASY = 6, 3
DIGEST = 12  # hexadecimal digits
OUT_CHARS = 4 << 20  # code points of texts whose results go out together


def _gear(points: np.ndarray) -> np.ndarray:
    """The rolling hash at each code point."""
    x = points.astype(np.uint32) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    h = (x >> np.uint32(16)).astype(np.uint16)
    for width in (1, 2, 4, 8):  # sums over the last 2, 4, 8, 16 code points
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
    return h


def chunks(text: str) -> list[str]:
    """The text cut where its content says so."""
    n = len(text)
    if n <= LEAST:
        return [text] if text else []
    h = _gear(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
    easy = np.flatnonzero(h >> np.uint16(16 - EASY) == 0)
    hard = easy[h[easy] >> np.uint16(16 - HARD) == 0].tolist()
    easy = easy.tolist()
    out, at = [], 0
    while at < n:
        # a cut stands behind its code point
        end = min(at + MOST, n)
        k = bisect_left(hard, at + LEAST - 1)
        if k < len(hard) and hard[k] < at + NORMAL - 1:
            end = min(hard[k] + 1, n)
        else:
            k = bisect_left(easy, at + NORMAL - 1)
            if k < len(easy) and easy[k] < end:
                end = easy[k] + 1
        out.append(text[at:end])
        at = end
    return out


def fingerprint(text: str | None) -> dict[str, int]:
    """{digest: code points that its chunks cover}"""
    out: dict[str, int] = {}
    for c in chunks(text or ""):
        d = xxhash.xxh3_64_hexdigest(c.encode("utf-8", "surrogatepass"))[:DIGEST]
        out[d] = out.get(d, 0) + len(c)
    return out


def written(print_: dict[str, int]) -> str:
    return " ".join(f"{d}:{w}" for d, w in sorted(print_.items()))


def read(line: str) -> dict[str, int]:
    return {d: int(w) for d, _, w in (x.partition(":") for x in line.split())}


def contained(a: dict[str, int], b: dict[str, int]) -> float:
    """The share of a's weight that b covers; nothing is contained fully, but in no text."""
    total = sum(a.values())
    if not total:
        return 1.0 if not b else 0.0
    return sum(min(w, b[d]) for d, w in a.items() if d in b) / total


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``n_chars`` and ``fingerprint``."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(list(map(len, texts)), pa.int64()),
                                              pa.array([written(fingerprint(t)) for t in texts], pa.string())],
                                             names=["id", "n_chars", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def _range_of(number: Column, cuts: list[int]) -> Column:
    """How many of the cuts, which fall, are above the number: found among every w-th one, then among the w behind it."""
    w = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k:k + w] for k in range(0, len(cuts), w)]
    above = lambda a: F.size(F.filter(a, lambda c: number < c))
    whole = above(F.lit([g[-1] for g in groups]))
    rest = above(F.get(F.lit([g + g[-1:] * (w - len(g)) for g in groups]), whole))
    return F.least(whole * w + F.coalesce(rest, F.lit(0)), F.lit(len(cuts)))  # the last group may be a short one


def _dealt(rows: DataFrame, ranges: int) -> DataFrame:
    """The rows (id, place, text) with the ``part`` they are worked in and ``ahead``: whether a row only follows there.

    Parts are ranges of ids in descending order, nulls last.  Collected: one bound and one first row (without text) a part."""
    spark = rows.sparkSession
    shares = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("id", shares, 10 * ranges).alias("c")).first().c if shares else None
    cuts = sorted(set(cuts or []), reverse=True)
    part = _range_of(F.col("id"), cuts) if cuts else F.lit(0)
    rows = rows.withColumn("part", F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(part).cast("int"))
    firsts = (rows.groupBy("part").agg(F.min(F.struct(F.bitwise_not("id").alias("down"), "place", "id")).alias("f"))
              .select("part", "f.id", "f.place").orderBy("part").collect())
    if not firsts:
        return rows.withColumn("ahead", F.lit(False))
    # what stands first in a part follows the part before; the whole table's first row follows the last part
    leads = [(r.part, r.id, r.place, firsts[k - 1].part) for k, r in enumerate(firsts)]
    lead = F.broadcast(spark.createDataFrame(leads, "f_part int, f_id long, f_place long, before int"))
    rows = rows.join(lead, (F.col("part") == F.col("f_part")) & F.col("id").eqNullSafe(F.col("f_id")) & (F.col("place") == F.col("f_place")), "left")
    own, follows = F.struct("part", F.lit(False).alias("ahead")), F.struct(F.col("before").alias("part"), F.lit(True).alias("ahead"))
    rows = rows.select("id", "place", "text", F.inline(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, follows))))
    return rows.repartitionById(len(cuts) + 2, "part")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``: how much of the
    text stands in its edited version and in the document that follows in descending order of ids."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("place"), "text")
    rows = _dealt(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.sortWithinPartitions("part", "ahead", F.col("id").desc_nulls_last(), "place", "text").select("part", "ahead", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held, last = 0, None
        for batch in batches:
            for part, ahead, i, text in zip(*(batch[c] for c in ("part", "ahead", "id", "text"))):
                part, ahead, i, text = part.as_py(), ahead.as_py(), i.as_py(), text.as_py()
                if ahead and last is None:
                    continue  # a copy of the row ahead that was used
                print_ = fingerprint(text)
                if last is not None:
                    out.append(_compared(*last, text, print_))
                    held += len(last[1])
                last = None if ahead else (i, text, print_)
                if held >= OUT_CHARS:
                    yield pa.RecordBatch.from_pylist(out, RESULT)
                    out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, RESULT)

    kinds = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(run, kinds).withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


RESULT = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(i: int | None, text: str, own: dict[str, int], following: str, next_print: dict[str, int]) -> dict[str, object]:
    changed = edited(text, following)
    changed_print = fingerprint(changed)
    return {"id": i, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": written(own), "edited_fingerprint": written(changed_print),
            "near_edited": contained(own, changed_print), "near_next": contained(own, next_print)}
