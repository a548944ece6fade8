"""Benchmark decontamination by a distributed positional inverted index (DataFrame functions only).

1. ``df`` of every term that a test item uses: the corpus' words are counted first (partial counts before the shuffle),
   then joined with the items' terms.
2. Each window of an item (``window`` consecutive words; a shorter item is one window) is looked up through its
   ``rarest`` rarest terms; only the postings (term, document, position) of those terms are stored.
3. A posting minus the term's place in the item is the offset at which the item would lie in the document.  Offsets of
   one document and item meet in stretches of ``STRETCH`` offsets (overlapping by the tolerance, so of bounded size), and
   the lists are intersected there: an offset stays where enough of a window's rarest terms lie within the tolerance.
4. At the offsets left, the item's words are compared with that part of the document.  Exact phrase: ``window`` equal words
   in a row.  Proximity match, where the item has no exact phrase in the document: of some window all words but ``changed``
   (shorter items: all) stand within ``slack`` places of where one common offset puts them.

Both are complete: a window with at most c words out of place has at least ``rarest - c`` of its rarest terms in place, and
two words in place lie at offsets at most ``2 * slack`` apart.  Windows with more unknown words than may be out of place
are not looked up.  A common passage gives one candidate per document and item; texts move once, to meet the numbers of
their own candidates, and only stretches of them go on to meet the items' words.

Words are ASCII-lower-cased runs of digits, letters a-z and anything beyond ASCII.  Defined cases: null and empty texts
have no words; an item without words is never found; repeated item ids count once; items with a null id hit words but
are not listed; documents with equal ids are judged each by its own text; empty tables give no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.shared import Scratch, ascii_lower, free_name, with_keys

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
RAREST = 3
CHANGED = 1
SLACK = 2
#: A power of two.
STRETCH = 32


def parts(text: Column) -> Column:
    """The words, with an empty string before them if the text begins with a separator, and after them likewise."""
    return F.split(ascii_lower(text), BETWEEN)


def words(text: Column) -> Column:
    return F.array_remove(parts(text), "")


def _count(split: Column) -> Column:
    """How many words a split has: an empty string can only be its first or last element."""
    one = lambda at: F.when(F.element_at(split, at) == "", 1).otherwise(0)
    return F.size(split) - one(1) - F.when(F.size(split) > 1, one(-1)).otherwise(0)


def _tokens(corpus: DataFrame) -> DataFrame:
    """(id, pos, term) of every word of the corpus."""
    return (corpus.select("id", F.when(F.element_at("parts", 1) == "", 1).otherwise(0).alias("skip"),
                          F.posexplode("parts").alias("at", "term"))
            .where("term <> ''").select("id", (F.col("at") - F.col("skip")).alias("pos"), "term"))


def _may_change(n: Column, window: int, changed: int) -> Column:
    """How many words of a window may be out of place, by the item's length."""
    return F.when(n >= window, F.lit(changed)).otherwise(F.lit(0))


def _anchors(items: DataFrame, corpus: DataFrame, window: int, rarest: int, changed: int) -> DataFrame:
    """(item, n, at, term): for each window of an item its rarest terms in the corpus (ties: the earliest in the item)."""
    places = items.select("item", F.posexplode("words").alias("at", "term"))
    terms = places.select("term").distinct()
    df = (corpus.select(F.explode("parts").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(terms, "term"))
    n = F.size("words")
    starts = items.select("item", n.alias("n"), F.explode(F.sequence(F.lit(0), n - F.least(n, F.lit(window)))).alias("start"))
    # the window of a start: positions start .. start + window - 1 of the same item
    inside = (starts.select("item", "n", "start", F.explode(F.sequence(F.col("start"), F.col("start") + window - 1)).alias("at"))
              .join(places, ["item", "at"]).join(df, "term", "left"))
    ranked = inside.groupBy("item", "n", "start").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce(F.col("df"), F.lit(0)).alias("df"), "at", "term"))).alias("terms"))
    unknown = F.size(F.filter("terms", lambda t: t["df"] == 0))
    asked = ranked.where(unknown <= _may_change(F.col("n"), window, changed)).select("item", "n", F.explode(F.slice("terms", 1, rarest)).alias("t"))
    return asked.where("t.df > 0").select("item", "n", F.col("t.at").alias("at"), F.col("t.term").alias("term")).distinct()


def _intersected(postings: DataFrame, window: int, rarest: int, changed: int, slack: int) -> DataFrame:
    """(id, found): per document the candidates (item, n, diag) whose neighbouring offsets hold enough of a window's rarest
    terms.  A stretch and item have at most ``STRETCH + 2 * slack`` offsets with one entry per place of the item."""
    reach = 2 * slack
    diag, bucket = F.col("diag"), F.shiftright("diag", STRETCH.bit_length() - 1)
    both = F.when(diag.bitwiseAND(STRETCH - 1) < reach, F.array(bucket, bucket - 1)).otherwise(F.array(bucket))
    n = F.col("n")
    need = F.greatest(F.lit(1), F.least(n, F.lit(rarest)) - _may_change(n, window, changed))
    met = (postings.select("id", "item", "n", (F.col("pos") - F.col("at")).alias("diag"), "at")
           .select("id", "item", "n", F.explode(both).alias("bucket"), F.struct("diag", "at").alias("entry"))
           .groupBy("id", "item", "n", "bucket").agg(F.collect_set("entry").alias("entries")).where(F.size("entries") >= need))
    close = lambda e: F.filter("entries", lambda o: (F.abs(e["diag"] - o["diag"]) <= reach) & (F.abs(e["at"] - o["at"]) < window))
    places = lambda e: F.size(F.array_distinct(F.transform(close(e), lambda o: o["at"])))
    left = F.filter("entries", lambda e: places(e) >= need)
    return (met.select("id", "item", "n", F.explode(F.array_distinct(F.transform(left, lambda e: e["diag"]))).alias("diag"))
            .groupBy("id").agg(F.collect_set(F.struct("item", "n", "diag")).alias("found")))


def _exact(window: int) -> Column:
    """Document positions inside runs of ``window`` words that are ``equal`` at the candidate's offset."""
    n = F.size("equal")
    w = F.least(n, F.lit(window))
    starts = F.filter(F.sequence(F.lit(0), n - w), lambda s: F.forall(F.slice("equal", s + 1, w), lambda x: x))
    return F.flatten(F.transform(starts, lambda s: F.sequence(F.col("diag") + s, F.col("diag") + s + w - 1)))


def _near(window: int, changed: int, slack: int) -> Column:
    """Whether, at an offset within ``slack`` of the candidate's, a window has all words but ``changed`` in place."""
    n = F.size("words")
    w = F.least(n, F.lit(window))
    stands = lambda d, word, i: F.exists(F.sequence(F.lit(-slack), F.lit(slack)),
                                         lambda e: F.coalesce(F.get(F.col("part"), d + e - F.col("first") + i) == word, F.lit(False)))
    offsets = F.sequence(F.col("diag") - slack, F.col("diag") + slack)
    in_place = F.transform(offsets, lambda d: F.transform("words", lambda word, i: stands(d, word, i)))
    return F.exists(in_place, lambda ok: F.exists(F.sequence(F.lit(0), n - w), lambda s: F.size(F.filter(
        F.slice(ok, s + 1, w), lambda x: x)) >= w - _may_change(n, window, changed)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
                  window: int = WINDOW, rarest: int = RAREST, changed: int = CHANGED, slack: int = SLACK) -> DataFrame:
    """Per document: ``n_words, n_hit, n_items, items_sha256, contaminated``; also the ``items`` found, the hit word
    positions' ``first_hit``, and the proximity matches ``near_items`` and their number ``n_near``."""
    if not 0 <= changed < rarest:
        raise ValueError("at least one of a window's rarest terms must be in place: 0 <= changed < rarest")
    tmp = Scratch(docs.sparkSession, "postings")
    rows = tmp.write(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), "text"))
    return _judged(tmp, rows, benchmark, item_col, window, rarest, changed, slack).withColumnRenamed("id", id_col).drop("row")


def _judged(tmp: Scratch, rows: DataFrame, benchmark: DataFrame, item_col: str, window: int, rarest: int, changed: int,
            slack: int) -> DataFrame:
    """The judgement of each of the written rows (row, id, text); the row number alone tells rows apart."""
    corpus = rows.select(F.col("row").alias("id"), parts(F.col("text")).alias("parts"))
    items = tmp.write(benchmark.select(F.monotonically_increasing_id().alias("item"),
                                       F.col(item_col).cast("string").alias("name"), words(F.col("text")).alias("words"))
                      .where(F.size("words") > 0))
    anchors = tmp.write(_anchors(items, corpus, window, rarest, changed))
    found = tmp.write(_intersected(_tokens(corpus).join(anchors, "term"), window, rarest, changed, slack))
    read = tmp.write(_stretches(rows, found, slack))
    # each candidate's part of its document meets the item's words
    c = read.select("row", F.explode("stretches").alias("c")).select("row", "c.*").join(items, "item")
    equal = F.transform("words", lambda word, i: F.coalesce(F.get("part", F.col("diag") - F.col("first") + i) == word, F.lit(False)))
    # the barrier: what the lambdas below read is evaluated once
    c = c.select(F.explode(F.array(F.struct("row", "name", "diag", "first", "part", "words", equal.alias("equal")))).alias("c")).select("c.*")
    near = _near(window, changed, slack) if changed or slack else F.lit(False)
    c = c.withColumn("at", _exact(window)).select("row", "name", "at", F.when(F.size("at") == 0, near).otherwise(F.lit(False)).alias("near"))
    hits = c.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("at"),
                                F.collect_set(F.when(F.size("at") > 0, F.col("name"))).alias("items"),
                                F.collect_set(F.when(F.col("near"), F.col("name"))).alias("near"))
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    both = read.select("row", "id", "n_words").join(hits, "row", "left").select(
        "row", "id", "n_words", empty(F.col("at"), "array<int>").alias("at"), F.array_sort(empty(F.col("items"), "array<string>")).alias("items"),
        empty(F.col("near"), "array<string>").alias("near"))
    n_hit = F.size("at").cast("long")
    near_items = F.array_sort(F.array_except("near", "items"))
    return both.select(
        "row", "id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "items",
        F.array_min("at").alias("first_hit"), F.size(near_items).cast("long").alias("n_near"), near_items.alias("near_items"))


def _stretches(rows: DataFrame, found: DataFrame, slack: int) -> DataFrame:
    """(row, id, n_words, stretches): of each candidate the document's words around it, ``part`` from position ``first``."""
    both = rows.join(found.withColumnRenamed("id", "row"), "row", "left")
    none = F.col("found").isNull()
    # the barrier: words are extracted once a document and not inside the lambdas below
    both = both.select("row", "id", F.explode(F.array(F.struct(
        F.when(none, F.split(F.coalesce(F.col("text"), F.lit("")), BETWEEN_ANY_CASE)).alias("split"),
        F.when(~none, words(F.col("text"))).alias("words"), "found"))).alias("d"))
    reach = 2 * slack
    first = lambda c: F.greatest(F.lit(0), c["diag"] - reach)
    stretches = F.transform("d.found", lambda c: F.struct(
        c["item"].alias("item"), c["diag"].alias("diag"), first(c).alias("first"),
        F.slice(F.col("d.words"), first(c) + 1, c["diag"] + c["n"] + reach - first(c)).alias("part")))
    n_words = F.when(F.col("d.words").isNull(), _count(F.col("d.split"))).otherwise(F.size("d.words"))
    return both.select("row", "id", n_words.cast("long").alias("n_words"), stretches.alias("stretches"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that are not contaminated, each by its own text, with the columns they came with.  Exact phrases alone
    decide that, so two rarest terms are intersected at one offset."""
    tmp = Scratch(docs.sparkSession, "contaminated")
    key = free_name(docs, "podium_row")
    rows = tmp.write(docs.withColumn(key, F.monotonically_increasing_id()))
    judged = _judged(tmp, rows.select(F.col(key).alias("row"), F.col(id_col).alias("id"), "text"), benchmark, "item_id", WINDOW, 2, 0, 0)
    bad = tmp.write(judged.where("contaminated").select(F.col("row").alias(key)))
    return with_keys(rows, key, bad, kept=False).select(*docs.columns)
