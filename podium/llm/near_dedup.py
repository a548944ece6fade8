"""MinHash near-duplicate groups with odd sketches.

1. Tasks turn each whole text into its set of word shingles (64-bit hashes), ``bands * rows`` MinHash values and one key
   per band.  Documents with equal sets form one class, of which the smallest id goes on; the copies follow it without
   pairs.
2. Classes that share a band key with another class get an odd sketch of ``samples`` MinHash values: each flips one bit of
   a bitmap, so the bits that differ between two bitmaps (XOR, population count) estimate how many samples differ,
   precisely where the similarity is high.
3. In each key's bucket every class is compared with the smallest one (star); odd sketch and set sizes discard what
   cannot be similar enough; the rest is confirmed on the full sets, and confirmed links merge into components.
4. Buckets that still hold several components get the exhaustive step: the members outside the bucket's largest
   component meet all members of other components.  Both sides are dealt in chunks of bounded size and compared inside
   tasks, bitmap against bitmap; only pairs that pass the sketch go on to the full sets.  A pair is compared in the first
   band that it shares.  It runs twice: first only the likeliest pairs that could merge components leave a task, then,
   with the components so merged, all that remain.  So no pairs of a component are ever made, no link between components
   is left out, and no bucket is capped.

A link of similarity 0.8 is missed only if no band agrees or the sketch is off by four standard errors: about 4e-5, and less above.

Defined cases: null and empty texts have no shingles and stand alone; texts with fewer words than a shingle have one,
the whole sequence; rows of one id with different texts get their own text's component, and that id stands for the text
with the smallest digest; rows with a null id take no part in groups and come
out alone, with the size of their set (null component, kept).  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.shared import LOWER, UPPER, Scratch, free_name, ship, with_keys

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = str.maketrans(UPPER, LOWER)
BANDS, ROWS = 24, 4
SAMPLES, SKETCH_BITS = 1024, 4096
LIKELY = 0.82  # pairs that look at least this similar are tried first
CHUNK = 4096
SIDE_BLOCK = 64
HASH_BLOCK = 4096  # shingles hashed by all functions at a time

_random = np.random.default_rng(20240229)
_MULTIPLY = _random.integers(1, 1 << 32, (2, 4096), dtype=np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    w = WORDS.findall((text or "").translate(TO_LOWER) if not (text or "").isascii() else (text or "").lower())
    if not w:
        return np.empty(0, np.uint64)
    raw = [x.encode("utf-8", "surrogatepass") for x in w]
    if len(w) <= words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(raw))], np.uint64)
    parts = [raw[i:len(raw) - words + 1 + i] for i in range(words)]
    digest = xxhash.xxh3_64_intdigest
    return np.array(sorted({digest(x) for x in map(b" ".join, zip(*parts))}), np.uint64)


def min_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """The minimum of each of k hash functions over the set."""
    a, b = (_MULTIPLY[0, :k] | np.uint64(1)).astype(np.uint32), _MULTIPLY[1, :k].astype(np.uint32)
    # two halves, so that equal low words don't make functions agree
    low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(k, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(hashes), HASH_BLOCK):
        x = a[:, None] * low[None, i:i + HASH_BLOCK]
        x += b[:, None] ^ high[None, i:i + HASH_BLOCK]
        best = np.minimum(best, x.min(1))
    return best


def band_keys(mins: np.ndarray, bands: int, rows: int) -> list[int]:
    return [xxhash.xxh3_64_intdigest(mins[i * rows:(i + 1) * rows].tobytes(), seed=i) - (1 << 63) for i in range(bands)]


def odd_sketch(mins: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap: sample i with value v flips bit hash(i, v)."""
    i = np.arange(len(mins), dtype=np.uint64)
    h = (mins.astype(np.uint64) + (i << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.packbits(np.bincount((h >> np.uint64(40)) % np.uint64(bits), minlength=bits).astype(np.uint8) & 1)


def most_different(similarity: float, samples: int, bits: int, errors: float = 4) -> int:
    """Differing bits that a pair of at least this similarity does not exceed, that many standard errors out (none:
    those of a pair of just this similarity).

    A sample differs with probability 1 - s and then flips two bits; bits fall into ``bits`` places at random."""
    differ = samples * (1 - similarity) + errors * np.sqrt(samples * similarity * (1 - similarity))
    flips = 2 * min(differ, samples)
    odd = bits / 2 * (1 - np.exp(-2 * flips / bits))
    return int(np.ceil(odd + (np.sqrt(odd) if errors else 0)))


SIGNED = "id {kind}, n long, fp string, keys array<long>"


def _fingerprint(shingles: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(shingles.tobytes())


def signed(docs: DataFrame, id_col: str, words: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for i, text in zip(frame["id"], frame["text"]):
                s = shingle_set(text, words)
                if len(s):
                    out.append((i, len(s), _fingerprint(s), band_keys(min_hashes(s, bands * rows), bands, rows)))
                else:
                    out.append((i, 0, None, None))
            yield pd.DataFrame(out, columns=["id", "n", "fp", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), "text").where("id is not null").mapInPandas(run, SIGNED.format(kind=kind))


def _big_enough(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _alike(pairs: DataFrame, limit: int) -> DataFrame:
    """Pairs whose bitmaps differ in at most ``limit`` bits."""
    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1) ^ np.frombuffer(b"".join(b), np.uint8).reshape(len(b), -1)
        return pd.Series(np.bitwise_count(x).sum(1) <= limit)

    return pairs.where(close("sketch_a", "sketch_b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out)

    a, b = (sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").where(linked("set_a", "set_b")).select("a", "b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): for each node of (a, b) edges the smallest id it is connected with.

    Alternating large-star and small-star steps, each written, so lineage stays short."""
    tmp = Scratch(edges.sparkSession, name)
    now = tmp.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = tmp.write(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        after = tmp.write(small)
        tmp.drop(now, large)
        now = after
        # done when the edges are stars: no node has two centres or is the centre of one and has another
        ends = (now.select("u", F.lit(1).alias("has"), F.lit(0).alias("is"))
                .unionByName(now.select(F.col("v").alias("u"), F.lit(0).alias("has"), F.lit(1).alias("is"))))
        if ends.groupBy("u").agg(F.sum("has").alias("has"), F.max("is").alias("is")).where("has + is > 1").isEmpty():
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _labelled(members: DataFrame, parts: DataFrame) -> DataFrame:
    return (members.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id")))


def _compare(batches: Iterator[pd.DataFrame], limit: int, percent: int, forest: bool) -> Iterator[pd.DataFrame]:
    """Candidate pairs of each (key, x, y) group; rows come sorted by group, a group may span batches."""
    held = None
    for frame in batches:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        group = frame[["key", "x", "y"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(1)]) if len(frame) else np.zeros(1, int)
        held = frame.iloc[starts[-1]:]
        yield _pairs(frame.iloc[:starts[-1]], starts[:-1], limit, percent, forest)
    if held is not None and len(held):
        yield _pairs(held, np.zeros(1, int), limit, percent, forest)


def _pairs(frame: pd.DataFrame, starts: np.ndarray, limit: int, percent: int, forest: bool) -> pd.DataFrame:
    found: list[tuple] = []
    if len(frame):
        sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint64).reshape(len(frame), -1)
        keys = np.stack(frame["keys"].to_numpy())
        side, band, out, n, part, ids = (frame[c].to_numpy() for c in ("side", "band", "out", "n", "component", "id"))
        for s, e in zip(starts, [*starts[1:], len(frame)]):
            middle = s + int(np.searchsorted(side[s:e], 1))
            left, b = slice(s, middle), int(band[s])
            kept = []
            for at in range(middle, e, SIDE_BLOCK):
                right = slice(at, min(at + SIDE_BLOCK, e))
                ok = ((part[left, None] != part[None, right]) & (100 * np.minimum(n[left, None], n[None, right]) >= percent * np.maximum(n[left, None], n[None, right]))
                      & ~(out[left, None] & (ids[left, None] > ids[None, right])))
                i, j = np.nonzero(ok)
                i, j = i + s, j + at
                apart = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1, dtype=np.int64)
                ok = apart <= limit
                i, j, apart = i[ok], j[ok], apart[ok]
                ok = ~(keys[i, :b] == keys[j, :b]).any(1)  # else compared in an earlier band
                kept.append((i[ok], j[ok], apart[ok]))
            if not kept:
                continue
            i, j, apart = (np.concatenate(c) for c in zip(*kept))
            if forest:
                i, j = _merging(i, j, apart, part)
            found += zip(ids[i], ids[j])
    return pd.DataFrame(found, columns=["a", "b"])


def _merging(i: np.ndarray, j: np.ndarray, apart: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs, likeliest first, that join two components not yet joined by those before."""
    root: dict = {}

    def find(c):
        while root.setdefault(c, c) != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    taken = []
    for k in np.argsort(apart, kind="stable"):
        a, b = find(part[i[k]]), find(part[j[k]])
        if a != b:
            root[a] = b
            taken.append(k)
    return i[taken], j[taken]


def _across(members: DataFrame, parts: DataFrame, light: DataFrame, kind: str, limit: int, percent: int,
            forest: bool) -> DataFrame:
    """Candidate pairs between different components of the same bucket: every member outside the bucket's largest
    component against all members, in chunks of at most ``CHUNK`` on either side."""
    known = _labelled(members.select("key", "band", "id"), parts)
    tmp = Scratch(members.sparkSession, "across")
    sizes = tmp.write(known.groupBy("key", "component").count())
    largest = tmp.write(sizes.groupBy("key").agg(F.max(F.struct("count", "component")).alias("m"), F.sum("count").alias("all"), F.count(F.lit(1)).alias("parts"))
                        .where("parts > 1").select("key", F.col("m.component").alias("main"), "all", (F.col("all") - F.col("m.count")).alias("outside")))
    rest = known.join(largest, "key").join(light, "id").withColumn("out", F.col("component") != F.col("main"))
    chunks = lambda n: F.ceil(F.col(n) / CHUNK).cast("int")
    own = lambda n: F.pmod(F.xxhash64("id"), chunks(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), chunks(n) - 1)
    # a member stands on the left for each chunk of outsiders, an outsider also on the right for each chunk of members
    left = F.transform(every("outside"), lambda y: F.struct(F.lit(0).alias("side"), own("all").alias("x"), y.alias("y")))
    right = F.transform(every("all"), lambda x: F.struct(F.lit(1).alias("side"), x.alias("x"), own("outside").alias("y")))
    dealt = (rest.select("key", "band", "id", "component", "n", "sketch", "keys", "out",
                         F.explode(F.when(F.col("out"), F.concat(left, right)).otherwise(left)).alias("c"))
             .select("key", "c.x", "c.y", "c.side", "band", "id", "component", "n", "sketch", "keys", "out"))
    dealt = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "side")
    return dealt.mapInPandas(lambda batches: _compare(batches, limit, percent, forest), f"a {kind}, b {kind}").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", words: int = 5, percent: int = 80, bands: int = BANDS,
                rows: int = ROWS, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``: component_id is the smallest id reachable over links."""
    spark = docs.sparkSession
    ship(spark)
    tmp = Scratch(spark, "near")
    limit = most_different(percent / 100, samples, bits)
    kind = docs.schema[id_col].dataType.simpleString()

    all_rows = tmp.write(signed(docs, id_col, words, bands, rows))
    firsts = tmp.write(all_rows.where("n > 0").groupBy("fp").agg(F.min("id").alias("first")))
    heads = (all_rows.where("n > 0").join(firsts.select(F.col("first").alias("id"), "fp"), ["id", "fp"], "left_semi")
             .groupBy("id").agg(F.min(F.struct("fp", "n", "keys")).alias("h")).select("id", "h.fp", "h.n", "h.keys"))

    # buckets with at least two classes
    keyed = heads.select("id", F.posexplode("keys").alias("band", "key"))
    shared = tmp.write(keyed.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last").select("key", "centre"))
    members = tmp.write(keyed.join(shared, "key").select("key", "band", "id", "centre"))

    # full sets and sketches of the classes that share a bucket, from the whole texts
    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for i, n, fp, keys, text in zip(frame["id"], frame["n"], frame["fp"], frame["keys"], frame["text"]):
                s = shingle_set(text, words)
                if _fingerprint(s) == fp:
                    out.append((i, n, keys, odd_sketch(min_hashes(s, samples), bits).tobytes(), s.tobytes()))
            yield pd.DataFrame(out, columns=["id", "n", "keys", "sketch", "set"])

    asked = tmp.write(heads.join(members.select("id").distinct(), "id", "left_semi"))
    texts = docs.select(F.col(id_col).alias("id"), "text")
    sets = tmp.write(texts.join(asked, "id").select("id", "n", "fp", "keys", "text")
                     .mapInPandas(sets_of, f"id {kind}, n long, keys array<long>, sketch binary, set binary").dropDuplicates(["id"]))
    light = sets.select("id", "n", "keys", "sketch")

    star = members.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    for c in "ab":
        star = star.join(light.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")), c)
    star = tmp.write(_alike(star.where(_big_enough(F.col("n_a"), F.col("n_b"), percent)), limit).select("a", "b"))
    links = tmp.write(_confirmed(star, sets, percent))
    parts = components(links)

    # buckets that still hold several components: likely links first, as many as can merge something; then all that is left
    for bound, forest in ((most_different(LIKELY, samples, bits, errors=0), True), (limit, False)):
        more = tmp.write(_across(members, parts, light, kind, bound, percent, forest))
        new = tmp.write(_confirmed(more, sets, percent))
        if not new.isEmpty():  # else the components stay as they are
            links = links.unionByName(new)
            parts = components(links)
    tmp.drop(sets, members)

    firsts = tmp.write(_labelled(firsts.select("fp", F.col("first").alias("id")), parts).select("fp", "component"))
    out = all_rows.join(firsts, "fp", "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    unknown = F.lit(None).cast(kind)
    nameless = docs.where(F.col(id_col).isNull()).select(F.lit(0).cast(kind).alias("id"), "text")
    out = out.unionByName(signed(nameless, "id", words, bands, rows).select(unknown.alias("id"), "n", unknown.alias("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group stays, with the columns it came with: the one with the smallest id, null ids last.  Rows are
    told apart by a key of their own, so equal and null ids take part like any other."""
    tmp = Scratch(docs.sparkSession, "near-kept")
    key = free_name(docs, "podium_row")
    rows = tmp.write(docs.withColumn(key, F.monotonically_increasing_id()))
    groups = near_groups(rows, key, words, percent).select(F.col(key).alias("row"), F.col("component_id").alias("component"))
    ids = rows.select(F.col(key).alias("row"), F.col(id_col).alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "row")).alias("first")
    kept = tmp.write(groups.join(ids, "row").groupBy("component").agg(first).select(F.col("first.row").alias(key)))
    return with_keys(rows, key, kept).select(*docs.columns)
