"""Spelling variant grouping with permuterm rotations (DataFrame functions only).

1. Words are counted over all whole texts; those of at least ``least_chars`` code points and ``least_count`` occurrences
   form the vocabulary.
2. Every word is marked with a terminator and turned into all its rotations.  A rotation that begins behind the code point
   at p ends with it; without that last code point it is the prefix of a range of the sorted rotations, and the
   terminator in it tells p.  Words whose rotations share such a prefix differ by a replacement at p; a word whose own whole
   rotation is that prefix lacks the code point at p.  So replacements, insertions and deletions all are words of one
   group of rotations with an equal prefix, and nothing else is.
3. Spark deals the rotations by prefix, sorts and scans the groups.  A group holds one word per code point that can be
   skipped and one whole rotation, so its size is bounded by the alphabet.  It emits, for each of its words, how
   many near words it saw and the best of them; no pairs.
4. These are added up per word.  A pair meets in one group only: replacements by their place; for a deletion inside a run of
   equal code points only the run's first place counts.
5. Forms are followed to the last one (root) by doubling: each step joins a word's root so far with that root's own.  A form
   occurs at least twice as often as the word, so chains are short.

The query's text rule (``altered_runs``) deletes one code point of some runs by a checksum of document and run.

Defined cases: null and empty texts have no words; a null id counts as empty in the checksum; repeated rows count each; ties
between near words go to the smallest in code-point order; an empty table or vocabulary gives no rows.  Words may not contain the
terminator (U+0001).  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.shared import LOWER, UPPER, Scratch

BETWEEN = r"[^A-Za-zÀ-ÿ]+"
END = "\x01"
LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
EVERY = 97  # a run whose checksum is divisible by this loses a code point


def altered_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY) -> DataFrame:
    """(word): each maximal run of letters, A-Z in lower case; if ``every`` divides the crc32 of ``id:run``, without the
    code point at that checksum modulo the run's length."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.split(text, BETWEEN)).alias("run")).where("run <> ''")
    check = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod(F.col("h"), F.char_length("run").cast("long")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return check.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, skipped, first, word, n): per word and place the rotation that ends with the code point there, without it
    (``first``: no equal code point stands right before it), and per place the whole rotation (``skipped`` null)."""
    marked = F.concat("word", F.lit(END))
    size = F.char_length("word")
    turned = lambda p: F.concat(F.substr(marked, p + 1), F.substr("word", F.lit(1), p))
    whole = F.transform(F.sequence(F.lit(0), size), lambda p: F.struct(
        turned(p).alias("prefix"), F.lit(None).cast("string").alias("skipped"), F.lit(False).alias("first")))
    letter = lambda p: F.substr("word", p + 1, F.lit(1))
    short = F.transform(F.sequence(F.lit(0), size - 1), lambda p: F.struct(
        F.concat(F.substr(marked, p + 2), F.substr("word", F.lit(1), p)).alias("prefix"), letter(p).alias("skipped"),
        ((p == 0) | (letter(p) != F.substr("word", p, F.lit(1)))).alias("first")))
    return words.select("word", "n", F.inline(F.concat(whole, short)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): of each word of (word, n) that has near words, how many and the one of largest n."""
    member = F.struct((-F.col("n")).alias("down"), "word", "skipped", "first")
    groups = (rotations(words).groupBy("prefix").agg(F.array_sort(F.collect_list(member)).alias("members"))
              .where(F.size("members") > 1))

    def seen(m: Column) -> Column:
        """The members that are near to m: all if it lacks nothing that they have, else those of equal length and the whole one."""
        return F.filter("members", lambda x: F.when(m["skipped"].isNull(), x["first"])
                        .otherwise((x["skipped"].isNotNull() & (x["word"] != m["word"])) | (x["skipped"].isNull() & m["first"])))

    each = groups.select(F.explode(F.transform("members", lambda m: F.struct(
        m["word"].alias("word"), F.size(seen(m)).alias("n_near"), F.get(seen(m), F.lit(0)).alias("best")))).alias("m"))
    best = F.min(F.struct("m.best.down", "m.best.word")).alias("best")  # members come sorted: the first near one is the best
    return (each.where("m.n_near > 0").groupBy(F.col("m.word").alias("word")).agg(F.sum("m.n_near").alias("n_near"), best))


def roots(tmp: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) of each word of (word, form): the last form of its chain."""
    now = tmp.write(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = tmp.write(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        tmp.drop(now)
        now = after.select("word", "root")
        now._podium_path = after._podium_path
        if after.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per row of a vocabulary (word, n): ``word, form, root, n, n_near, form_n``."""
    tmp = Scratch(words.sparkSession, "spelling")
    words = tmp.write(words.select("word", "n"))
    near = tmp.write(near_words(words))
    known = tmp.write(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.down") >= ratio * F.col("n"), F.col("best")).alias("best"))
        .select("word", F.col("best.word").alias("form"), "n", "n_near", (-F.col("best.down")).alias("form_n")))
    last = roots(tmp, known.where("form is not null"))
    return (known.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The variants among the words of whole texts, by the query's rule."""
    return group_variants(vocabulary(altered_runs(docs, id_col, text_col)))
