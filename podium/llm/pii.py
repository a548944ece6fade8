"""Surrogates for personal data (DataFrame functions only).

Detected entities - e-mail and IPv4 addresses, payment card and social security numbers, phone numbers, persons after
forms of address or a listed given name, with all names that follow, the last being the surname - are replaced by keyed surrogates of the same type and format:

* addresses keep their punctuation and top-level domain, equal domains stay equal; cards keep their network digit and, if
  valid, a valid check digit; phones keep prefix and layout; IP addresses stay valid and private ones private;
* listed given names come from a list of the same gender and script by a keyed permutation, others keep length, capitals
  and the pattern of vowels and consonants; surnames keep script, length,
  capitals, the pattern of vowels and consonants, and the ending that shows gender.

An entity is its canonical form (digits of a number, lower case of an address or name), so all its mentions, however
written and in whichever document, get the same surrogate.  Collision checks run over the table of distinct entities: a
surrogate that another entity claims, or that is itself an entity of the corpus, is drawn anew until all are distinct.
Where a format has too few surrogates, those left over get a wider one: kept digits are freed, then digits or letters
added; private IP addresses go to 10.0.0.0/8, then to any network.

Only texts with entities are shuffled.  Defined cases: null counts as empty and comes out as an empty text; texts without
entities come out unchanged; repeated rows come out each; columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.shared import Scratch

GIVEN = {
    "latin_f": "Anna Maria Laura Julia Emma Sophie Clara Lucia Elena Marta Alice Helen Claire Camille Ingrid Petra Monika Isabel Carmen Teresa Nora Olivia Diana Paula".split(),
    "latin_m": "John Peter Paul David Thomas Martin Daniel Michael Robert James William Pierre Jean Louis Hans Karl Stefan Pablo Carlos Miguel Jorge Henrik Oscar Victor".split(),
    "cyrillic_f": "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана Юлия Дарья Софья Вера".split(),
    "cyrillic_m": "Иван Пётр Сергей Андрей Алексей Дмитрий Николай Михаил Олег Павел Борис Юрий".split(),
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Señora Señor Sra Mme Mlle Monsieur Madame Господин Госпожа".split()
NAME = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+)?"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_GIVEN = "(?:" + "|".join(sorted((g for gs in GIVEN.values() for g in gs), key=lambda g: (-len(g), g))) + ")"
_TITLE = "(?:" + "|".join(sorted(TITLES, key=lambda t: (-len(t), t))) + r")\.?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    # a capital first, so that the lists are tried at few places; then all names that follow
    "person": rf"(?=[A-ZА-Я])(?<![\p{{L}}\p{{N}}_])(?:(?:{_TITLE} )+|{_GIVEN} ){NAME}(?![\p{{L}}])(?: {NAME}(?![\p{{L}}]))*+",
}
ANY = "|".join(PATTERNS.values())
#: A cheap test for texts that cannot hold an entity.
HINT = rf"[@0-9]|(?=[A-ZА-Я])(?:{_TITLE}|{_GIVEN}) "
NUMBERS = ("ssn", "phone", "card")
VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnprstvz"
_RU_VOWELS, _RU_CONSONANTS = "аеиоуя", "бвгдзклмнпрстфх"
#: Characters are replaced within their group.
GROUPS = ["0123456789", VOWELS, CONSONANTS + "qwxy", VOWELS.upper(), (CONSONANTS + "qwxy").upper(), _RU_VOWELS + "ёыэю", _RU_CONSONANTS + "жцчшщй",
          (_RU_VOWELS + "ёэю").upper(), (_RU_CONSONANTS + "жцчшщ").upper()]
#: An ending that shows gender, after at least one letter.
ENDING = r"(?i)(?<=.)(ова|ева|ина|ская|ов|ев|ин|ский)$"
#: From round ``WIDEN`` on every second round widens the format of those that have no surrogate yet by one step.
WIDEN = 6
#: Every format but that of IP addresses can be widened without end; rounds in a row that may pass without a new surrogate.
IDLE_ROUNDS = 40
ENTITIES_PER_TASK = 2000
FOLD = ("àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßьъ", "aaaaaaaceeeeiiiidnoooooouuuuypysнн")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _replaced(text: Column, seed: Column) -> Column:
    """Each character replaced within its group, by bytes of keyed digests (64 characters a digest)."""
    chars = _chars(text)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(chars) / 64).cast("int")), lambda b: F.sha2(F.concat_ws("|", seed, b.cast("string")), 512))

    def pick(c: Column, i: Column) -> Column:
        digest = F.get(blocks, F.floor(i / 64).cast("int"))
        number = F.conv(F.substring(digest, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for g in GROUPS:
            out = F.when(F.instr(F.lit(g), c) > 0, F.substring(F.lit(g), number % len(g) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(chars, pick), "")


def mentions(found: Column) -> Column:
    """(kind, canon) parts of a match: one, or for a person the given name and the surname."""
    kind = F.lit("person")
    for k in reversed([p for p in PATTERNS if p != "person"]):
        kind = F.when(found.rlike(f"^(?:{PATTERNS[k]})$"), k).otherwise(kind)
    return kind


def _canon(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9+]", "")
    return (F.when(kind == "email", F.lower(found)).when(kind == "ip", found)
            .when(kind == "person", F.lower(F.regexp_extract(found, f"{NAME}$", 0))).otherwise(digits))


def _key(key: str, *parts: Column) -> Column:
    return F.concat_ws("|", F.lit(key), *parts)


def _draw(key: str) -> Column:
    """The surrogate of (kind, canon) at the given round."""
    kind, canon = F.col("kind"), F.col("canon")
    seed = _key(key, kind, canon, F.col("round").cast("string"))
    wide = F.greatest(F.floor((F.col("round") - WIDEN) / 2) + 1, F.lit(0)).cast("int")
    more = lambda letters: F.substring(F.repeat(F.lit(letters), wide), F.lit(1), wide)
    # of an address the local part depends on the whole address, the domain on the domain
    at = F.instr(canon, "@")
    local, domain = F.substring(canon, F.lit(1), at - 1), F.substring_index(canon, "@", -1)
    top = F.substring_index(domain, ".", -1)
    site = F.substring(domain, F.lit(1), F.char_length(domain) - F.char_length(top))
    email = F.concat(_replaced(F.concat(local, more("an")), seed), F.lit("@"), _replaced(site, _key(key, F.lit("domain"), domain)), top)
    keep = (F.when(canon.startswith("+"), F.when(wide > 0, 1).when(canon.rlike(r"^\+[17]"), 2).otherwise(3))
            .when(kind == "card", 1).when((kind == "ssn") & (wide == 0), 1).otherwise(0))
    # the first step frees the kept digits, each further one adds a digit
    long = F.concat(canon, F.repeat(F.lit("0"), F.greatest(wide - 1, F.lit(0))))
    number = F.concat(F.substring(long, F.lit(1), keep), _replaced(F.substring(long, keep + 1, F.char_length(long)), seed))
    body = F.substring(number, F.lit(1), F.char_length(number) - 1)
    digits = F.filter(F.array(*(F.lit(str(d)) for d in range(10))), lambda d: F.call_function("luhn_check", F.concat(body, d)))
    card = F.when(F.call_function("luhn_check", canon), F.concat(body, F.get(digits, F.lit(0)))).otherwise(number)
    octets = F.split(canon, r"\.")
    byte = lambda i: F.conv(F.substring(F.sha2(seed, 256), 4 * i + 1, 4), 16, 10).cast("int")
    rest = [(byte(i) % 254 + 1).cast("string") for i in range(4)]
    free = [(byte(i) % 256).cast("string") for i in range(4)]
    ip = (F.when(wide > 1, F.concat_ws(".", (byte(0) % 213 + 11).cast("string"), *free[1:]))
          .when((wide > 0) & canon.rlike(r"^(10|192\.168)\."), F.concat_ws(".", F.lit("10"), *free[1:]))
          .when(canon.startswith("10."), F.concat_ws(".", F.lit("10"), *rest[1:]))
          .when(canon.startswith("192.168."), F.concat_ws(".", F.lit("192.168"), *rest[2:]))
          .otherwise(F.concat_ws(".", (byte(0) % 100 + 11).cast("string"), *rest[1:])))
    ending = F.regexp_extract(canon, ENDING, 1)
    stem = F.substring(canon, F.lit(1), F.char_length(canon) - F.char_length(ending))
    letters = F.when(canon.rlike("[а-яё]"), more("ан")).otherwise(more("an"))
    stem = F.when(wide > 0, F.concat(F.translate(stem, *FOLD), letters)).otherwise(stem)
    surname = F.concat(_replaced(stem, seed), ending)
    return F.when(kind == "email", email).when(kind == "card", card).when(kind == "ip", ip).when(kind == "person", surname).otherwise(number)


def _drawn(todo: DataFrame, key: str) -> DataFrame:
    """Surrogates of this round; drawing is dear and entities are small, so tasks go by their number, not by bytes."""
    tasks = -(-todo.count() // ENTITIES_PER_TASK) or 1
    return todo.repartition(tasks, "kind", "canon").withColumn("surrogate", _draw(key))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon): distinct surrogates, none of them an entity itself.

    A round draws for those that have none yet.  What was given before is only probed by the new claims, never rewritten:
    the few new claims reach it as the small side of a join."""
    tmp = Scratch(entities.sparkSession, "surrogates")
    entities = tmp.write(entities.distinct())
    real = entities.select("kind", F.col("canon").alias("surrogate"))
    fixed, todo, idle = None, entities.withColumn("round", F.lit(0)), 0
    while idle < IDLE_ROUNDS:
        drawn = tmp.write(_drawn(todo, key))
        claims = tmp.write(drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")))  # the smaller entity wins
        held = real if fixed is None else real.unionByName(fixed.select("kind", "surrogate"))
        taken = tmp.write(held.join(claims, ["kind", "surrogate"], "left_semi"))
        won = tmp.write(claims.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canon", "surrogate"))
        lost = tmp.write(drawn.join(won, ["kind", "canon"], "left_anti").select("kind", "canon", (F.col("round") + 1).alias("round")))
        idle = idle + 1 if won.isEmpty() else 0
        fixed = won if fixed is None else fixed.unionByName(won)
        tmp.drop(drawn, claims, taken)
        if lost.isEmpty():
            return fixed
        todo = lost
    raise ValueError(f"no surrogate found in {IDLE_ROUNDS} rounds: more than half of all IP addresses are entities")


def _given(key: str, word: Column) -> Column:
    """The next name of the same gender and script in an order that the key decides."""
    import hashlib

    out = word
    for names in GIVEN.values():
        order = sorted(names, key=lambda x: hashlib.sha256(f"{key}|{x}".encode()).hexdigest())
        for a, b in zip(order, order[1:] + order[:1]):
            out = F.when(word == a, b).otherwise(out)
    return out


def _front(key: str, word: Column) -> Column:
    """The surrogate of a word before the surname: forms of address stay, given names outside the lists are drawn."""
    low = F.translate(F.lower(word), *FOLD)
    drawn = _replaced(low, _key(key, F.lit("given"), low))
    # of a word that came out as itself, one letter more
    drawn = F.when(drawn == F.lower(word), F.concat(drawn, F.when(low.rlike("[а-яё]"), "н").otherwise("n"))).otherwise(drawn)
    listed = word.isin([g for names in GIVEN.values() for g in names])
    return (F.when((word == "") | word.rlike(f"^{_TITLE}$"), word).when(listed, _given(key, word)).otherwise(_same_case(drawn, word)))


def _same_case(surrogate: Column, found: Column) -> Column:
    """Capitals where the mention has them."""
    chars = F.arrays_zip(_chars(surrogate).alias("s"), _chars(found).alias("f"))
    return F.array_join(F.transform(chars, lambda c: F.when((c["f"] != F.lower(c["f"])), F.upper(c["s"])).otherwise(c["s"])), "")


def _render(key: str, kind: Column, found: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format."""
    place = lambda i: F.char_length(F.regexp_replace(F.substring(found, F.lit(1), i + 1), "[^0-9+]", ""))
    number = F.array_join(F.transform(_chars(found), lambda c, i: F.when(c.rlike("[0-9+]"), F.substring(surrogate, place(i), F.lit(1))).otherwise(c)), "")
    # the digits by which a full format was widened
    number = F.concat(number, F.substring(surrogate, F.char_length(F.regexp_replace(found, "[^0-9+]", "")) + 1, F.char_length(surrogate)))
    name = F.regexp_extract(found, f"{NAME}$", 0)
    front = F.substring(found, F.lit(1), F.char_length(found) - F.char_length(name))
    before = F.array_join(F.transform(F.split(front, " "), lambda w: _front(key, w)), " ")
    return (F.when(kind == "email", _same_case(surrogate, found)).when(kind == "ip", surrogate)
            .when(kind == "person", F.concat(before, _same_case(surrogate, name))).otherwise(number))


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id") -> DataFrame:
    """Per row ``doc_id, text`` with surrogates, ``n_entities``, and the count of each kind."""
    tmp = Scratch(docs.sparkSession, "pii")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    hit = F.col("text").rlike(HINT) & F.col("text").rlike(ANY)
    held = tmp.write(rows.where(hit).select(F.monotonically_increasing_id().alias("row"), "id", "text"))
    each = held.select("row", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("at", "found"))
    each = each.withColumn("kind", mentions(F.col("found")))
    each = tmp.write(each.withColumn("canon", _canon(F.col("kind"), F.col("found"))))
    table = surrogates(each.select("kind", "canon"), key)
    done = each.join(table, ["kind", "canon"]).select("row", "at", "kind", _render(key, F.col("kind"), F.col("found"), F.col("surrogate")).alias("new"))
    count = lambda k: F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}")
    per_row = done.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("new"), *(count(k) for k in PATTERNS))
    pieces = F.split("text", ANY)
    filled = F.zip_with(pieces, F.col("new"), lambda p, x: F.concat(p, F.coalesce(x["new"], F.lit(""))))
    changed = held.join(per_row, "row").select("id", F.array_join(filled, "").alias("text"), *(f"n_{k}" for k in PATTERNS))
    same = rows.where(~hit).select("id", "text", *(F.lit(0).cast("long").alias(f"n_{k}") for k in PATTERNS))
    total = sum((F.col(f"n_{k}") for k in PATTERNS), F.lit(0))
    return changed.unionByName(same).select(F.col("id").alias(id_col), "text", total.cast("long").alias("n_entities"), *(f"n_{k}" for k in PATTERNS))
