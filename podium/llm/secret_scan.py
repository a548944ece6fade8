"""Secret scans: three fixed patterns and a randomness test battery (DataFrame functions only).

Base spans come from the patterns ``assign``, ``access`` and ``hex``.  The battery adds spans of kind ``random``: runs of
20 and more characters of the base64 and URL alphabets that mix letters and digits and overlap no base span.  For each,
the encoding is inferred from its characters (hexadecimal, base32, base64) and its characters become indices into that
alphabet.  Three tests ask whether the indices could be random: chi-squared uniformity over the alphabet (Wilson-Hilferty),
the number of runs above and below the middle, and the lag-1 serial correlation; all must be consistent with it.  The
evidence against ordinary text is a p-value that falls with length: how unlikely text is to keep within the alphabet
(hexadecimal, base32) or to change between small letters, capitals, digits and signs that often (base64).

Discoveries are controlled over the whole corpus by a weighted Benjamini-Hochberg rule; a candidate's weight is its length
relative to the mean length.  The rule needs only how many candidates fall into each of a fixed number of bins of the
weighted p-value, so candidates are counted per task and no order of them is gathered.

Defined cases: null counts as empty; texts without matches have zero counts and the digest of an empty list; repeated
rows are scanned each; positions are code points, the end is exclusive.  Columns other than the id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.shared import Scratch

#: The contract's patterns, the group whose length counts and its least length.
PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: A run of 24 and more of the one class is found whole by the shorter search; both give the same spans.
SEARCH = {"hex": r"[0-9a-f]{24,}"}
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
KINDS = [*PATTERNS, "random"]

HEX_LOW, HEX_UP, BASE32 = "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
TEXT_SHARE = {"hex": 0.3, "base32": 0.35}  # of ordinary characters that fall into the alphabet in one case
CHANGE = 0.15  # of neighbours in ordinary identifiers that differ in class
FDR, BINS, BINS_PER_DECADE = 1e-4, 4000, 10
STEP = 256  # lengths summed at a time


def _where(parts: Column, found: Column) -> Column:
    """Start of each match, from the lengths of what lies between and of the matches; sums of ``STEP`` lengths at a time
    keep the work near linear where a text has very many matches."""
    both = F.zip_with(F.slice(parts, 1, F.size(found)), found, lambda p, m: F.struct(p.alias("p"), (p + m).alias("all")))
    return both


def _starts(both: Column, sums: Column) -> Column:
    add = lambda a, b: a + b
    zero = F.lit(0)
    return F.transform(both, lambda x, i: x["p"]
                       + F.aggregate(F.slice(sums, 1, F.floor(i / STEP).cast("int")), zero, add)
                       + F.aggregate(F.slice(both, (F.floor(i / STEP) * STEP + 1).cast("int"), i % STEP), zero, lambda a, y: a + y["all"]))


def _sums(both: Column) -> Column:
    steps = F.ceil(F.size(both) / STEP).cast("int")
    return F.when(steps > 0, F.transform(F.sequence(F.lit(0), F.greatest(steps, F.lit(1)) - 1), lambda k: F.aggregate(
        F.slice(both, k * STEP + 1, F.lit(STEP)), F.lit(0), lambda a, y: a + y["all"]))).otherwise(F.array().cast("array<int>"))


def _lengths(texts: Column) -> Column:
    return F.transform(texts, lambda x: F.char_length(x))


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by a logistic approximation good to 2e-4."""
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.070565 * z * z * z, F.lit(700.0))))


def _battery(token: Column) -> Column:
    """(consistent, log10 of the p-value against ordinary text) of a candidate."""
    core = F.regexp_replace(F.translate(token, "-_", "+/"), "=+", "")
    kind = (F.when(core.rlike("^[0-9a-f]+$"), "hexl").when(core.rlike("^[0-9A-F]+$"), "hexu").when(core.rlike("^[A-Z2-7]+$"), "base32").otherwise("base64"))
    letters = (F.when(kind == "hexl", HEX_LOW).when(kind == "hexu", HEX_UP).when(kind == "base32", BASE32).otherwise(BASE64))
    return F.struct(core.alias("core"), kind.alias("kind"), letters.alias("letters"), F.char_length(letters).cast("double").alias("k"),
                    F.char_length(core).cast("double").alias("n"),
                    F.transform(F.filter(F.split(core, ""), lambda c: c != ""), lambda c: F.instr(letters, c) - 1).alias("at"))


def _tested(b: Column) -> Column:
    n, k, at = b["n"], b["k"], b["at"]
    squares = F.aggregate(F.split(b["letters"], ""), F.lit(0.0), lambda s, c: s + F.when(c == "", 0.0).otherwise(
        F.pow(n - F.char_length(F.replace(b["core"], c, F.lit(""))), 2)))
    df = k - 1
    chi = F.greatest(k / n * squares - n, F.lit(1e-9))
    z_chi = (F.pow(chi / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    pairs = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    high = F.size(F.filter(at, lambda x: x * 2 >= k)).cast("double")
    low = n - high
    runs = 1 + F.size(F.filter(pairs, lambda p: (p["x"] * 2 >= k) != (p["y"] * 2 >= k)))
    mean = 2 * high * low / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(var > 0, F.abs(runs - mean) / F.sqrt(var)).otherwise(99.0)
    middle = F.aggregate(at, F.lit(0.0), lambda s, x: s + x) / n
    spread = F.aggregate(at, F.lit(0.0), lambda s, x: s + (x - middle) * (x - middle))
    joint = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["x"] - middle) * (p["y"] - middle))
    z_serial = F.when(spread > 0, F.abs(joint / spread) * F.sqrt(n)).otherwise(99.0)
    # each test at 0.1 %, the serial and runs tests two-sided
    consistent = (_normal_tail(z_chi) > 0.001) & (_normal_tail(z_runs) > 0.0005) & (_normal_tail(z_serial) > 0.0005)
    classes = F.translate(b["core"], BASE64, "U" * 26 + "l" * 26 + "d" * 10 + "ss")
    cs = F.filter(F.split(classes, ""), lambda c: c != "")
    changes = F.size(F.filter(F.zip_with(F.slice(cs, 1, F.size(cs) - 1), F.slice(cs, 2, F.size(cs) - 1), lambda x, y: x != y), lambda d: d))
    z_change = (changes - 0.5 - (n - 1) * CHANGE) / F.sqrt((n - 1) * CHANGE * (1 - CHANGE))
    against = (F.when(b["kind"].startswith("hex"), n * math.log10(TEXT_SHARE["hex"])).when(b["kind"] == "base32", n * math.log10(TEXT_SHARE["base32"]))
               .otherwise(F.log10(_normal_tail(z_change))))
    return F.struct(consistent.alias("consistent"), F.greatest(against, F.lit(-300.0)).alias("log_p"), n.alias("n"))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns computed once a row, behind a barrier that keeps them out of later lambdas."""
    df = df.withColumn("_new", F.explode(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))
    return df.select(*(c for c in df.columns if c != "_new" and c not in columns), *(F.col(f"_new.{k}").alias(k) for k in columns))


def find(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row the base spans and the tested candidates, one scan of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    new = {}
    searches = {k: SEARCH.get(k, p) for k, (p, _, _) in PATTERNS.items()} | {"random": CANDIDATE}
    for kind, pattern in searches.items():
        has = F.col("text").rlike(pattern)
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        new[f"{kind}_parts"] = F.when(has, _lengths(F.split("text", pattern)))
        new[f"{kind}_found"] = F.when(has, _lengths(found) if kind != "random" else found)
        group = PATTERNS[kind][1] if kind in PATTERNS else 0
        if group:
            new[f"{kind}_group"] = F.when(has, _lengths(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))))
    df = _once(df, **new).drop("text")
    lengths = lambda k: _lengths(F.col(f"{k}_found")) if k == "random" else F.col(f"{k}_found")
    df = _once(df, **{f"{k}_both": _where(F.col(f"{k}_parts"), lengths(k)) for k in searches})
    df = _once(df, **{f"{k}_sums": _sums(F.col(f"{k}_both")) for k in searches})
    df = _once(df, **{f"{k}_starts": _starts(F.col(f"{k}_both"), F.col(f"{k}_sums")) for k in searches})

    def spans(kind: str) -> Column:
        counted = f"{kind}_group" if PATTERNS[kind][1] else f"{kind}_found"
        every = F.arrays_zip(F.col(f"{kind}_starts").alias("start"), F.col(f"{kind}_found").alias("n"), F.col(counted).alias("counted"))
        kept = F.filter(every, lambda x: x["counted"] >= PATTERNS[kind][2])
        made = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (x["start"] + x["n"]).alias("end")))
        return F.coalesce(made, F.array().cast("array<struct<start:int,kind:int,end:int>>"))

    df = _once(df, **{k: spans(k) for k in PATTERNS})
    base = F.array_sort(F.concat(*(F.col(k) for k in PATTERNS)))
    df = _once(df, base=base)
    tokens = F.transform(F.arrays_zip(F.col("random_starts").alias("start"), F.col("random_found").alias("token")), lambda x: F.struct(
        x["start"].alias("start"), (x["start"] + F.char_length(x["token"])).alias("end"), x["token"].alias("token")))
    free = F.filter(tokens, lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    df = _once(df, free=F.transform(free, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), _battery(x["token"]).alias("b"))))
    tested = F.transform("free", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), _tested(x["b"]).alias("t")))
    return df.select("id", *(F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS), "base", tested.alias("tested"))


def threshold(found: DataFrame) -> tuple[float, float]:
    """(largest weighted log10 p-value that is a discovery, mean length), from counts per bin."""
    each = found.select(F.explode("tested").alias("x")).select("x.t.log_p", "x.t.n")
    total = each.agg(F.count(F.lit(1)).alias("m"), F.avg("n").alias("mean")).first()
    m, mean = total["m"], total["mean"] or 1.0
    weighted = F.col("log_p") - F.log10(F.col("n") / mean)
    bins = {r["bin"]: r["count"] for r in each.select(F.least(F.floor(-weighted * BINS_PER_DECADE), F.lit(BINS)).alias("bin"))
            .groupBy("bin").count().collect()}
    best, seen = -math.inf, 0
    for b in sorted(bins, reverse=True):  # from the smallest p-values on
        seen += bins[b]
        if -b / BINS_PER_DECADE <= math.log10(FDR * seen / m):
            best = -b / BINS_PER_DECADE
    return best, mean


def scan(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row ``n_assign, n_access, n_hex, base_sha256, spans``; also ``n_random``."""
    found = Scratch(docs.sparkSession, "secrets").write(find(docs, id_col))
    limit, mean = threshold(found)
    added = F.transform(F.filter("tested", lambda x: x["t"]["consistent"] & (x["t"]["log_p"] - F.log10(x["t"]["n"] / mean) <= limit)),
                        lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), x["end"].alias("end")))
    added = F.coalesce(added, F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    names = F.array(*map(F.lit, KINDS))
    shown = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    out = found.withColumn("added", added)
    return out.select(F.col("id").alias(id_col), *(f"n_{k}" for k in PATTERNS), F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
                      shown(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_random"))
