"""Replacement of personal data against a loop over matches: detection, kinds, canonical forms, rendering and counts on whole
texts of the given table and on hand-made rows.  Only the draw of (kind, canon) is taken from the operator; its properties
(one per entity, distinct, no entity itself) are checked here over all entities."""

import collections
import hashlib
import os

import pytest
import regex

from podium.llm import pii

DOCS = "/root/testdata/sf0.01/documents.parquet"
KEY = "another key"
ANY = regex.compile(pii.ANY)
NAME_AT_END = regex.compile(pii.NAME + "$")
LISTED = {g: names for names in pii.GIVEN.values() for g in names}
FOLD = str.maketrans(*pii.FOLD)
EXTRA = [
    (None, "Mr Novak wrote to novak@site.org"), (-1, None), (-2, ""), (-3, "Mr Novak, Ms Novak, Dr Ksenia Novak and Anna Novak"),
    (-3, "Mr Novak, Ms Novak, Dr Ksenia Novak and Anna Novak"), (-4, "10.0.0.7 and 192.168.0.9, 8.8.8.8. 1.2.3.4.5 256.1.1.1"),
    (-5, "+49 (30) 1234-5678; (275) 555-5927; 275.555.5927; 123-45-6789; 123-45-67890"), (-6, "4111 1111 1111 1111, 4111111111111112"),
    (-7, "A.B@C.example.COM a.b@c.example.com x" + " plain word" * 20_000 + " a.b@c.example.com"),
]


def kind_of(found):
    return next((k for k, p in pii.PATTERNS.items() if k != "person" and regex.fullmatch(p, found)), "person")


def canon_of(kind, found):
    if kind == "person":
        return NAME_AT_END.search(found).group().lower()
    return found.lower() if kind == "email" else found if kind == "ip" else regex.sub("[^0-9+]", "", found)


def same_case(new, found):
    return "".join(s.upper() if i < len(found) and found[i] != found[i].lower() else s for i, s in enumerate(new))


def front_word(word):
    if not word or regex.fullmatch(pii._TITLE, word):
        return word
    if word in LISTED:
        order = sorted(LISTED[word], key=lambda x: hashlib.sha256(f"{KEY}|{x}".encode()).hexdigest())
        return order[(order.index(word) + 1) % len(order)]
    low = word.lower().translate(FOLD)
    digest = hashlib.sha512(f"{KEY}|given|{low}|0".encode()).hexdigest()
    new = "".join(next((g[int(digest[2 * i:2 * i + 2], 16) % len(g)] for g in pii.GROUPS if c in g), c) for i, c in enumerate(low))
    if new == word.lower():
        new += "н" if regex.search("[а-яё]", low) else "n"
    return same_case(new, word)


def rendered(kind, found, new):
    if kind == "email":
        return same_case(new, found)
    if kind == "ip":
        return new
    if kind == "person":
        name = NAME_AT_END.search(found).group()
        return " ".join(map(front_word, found[:-len(name)].split(" "))) + same_case(new, name)
    rest = iter(new)
    return "".join(next(rest) if c in "0123456789+" else c for c in found) + "".join(rest)


def replaced(text, table):
    out, at, counts = [], 0, collections.Counter()
    for m in ANY.finditer(text):
        kind = kind_of(m.group())
        out += [text[at:m.start()], rendered(kind, m.group(), table[kind, canon_of(kind, m.group())])]
        at = m.end()
        counts[kind] += 1
    return "".join([*out, text[at:]]), counts


@pytest.mark.skipif(not os.path.exists(DOCS), reason="no test tables")
def test_replaced_texts_equal_a_loop_over_matches(spark):
    given = spark.read.parquet(DOCS).select("doc_id", "text")
    frame = given.unionByName(spark.createDataFrame(EXTRA, "doc_id long, text string"))
    rows = [(r.doc_id, r.text or "") for r in frame.collect()]
    entities = {(k, canon_of(k, m.group())) for _, text in rows for m in ANY.finditer(text) for k in [kind_of(m.group())]}
    drawn = pii.surrogates(spark.createDataFrame(sorted(entities) * 2, "kind string, canon string"), KEY).collect()
    table = {(r.kind, r.canon): r.surrogate for r in drawn}
    assert len(drawn) == len(table) == len(entities) > 80 and set(table) == entities
    assert len({(k, s) for (k, _), s in table.items()}) == len(table) and not {(k, s) for (k, _), s in table.items()} & entities
    expected = collections.Counter()
    for i, text in rows:
        new, n = replaced(text, table)
        expected[i, new, sum(n.values()), *(n[k] for k in pii.PATTERNS)] += 1
    got = pii.replace_pii(frame, KEY).select("doc_id", "text", "n_entities", *(f"n_{k}" for k in pii.PATTERNS)).collect()
    assert collections.Counter(map(tuple, got)) == expected


def test_drawing_is_dealt_by_the_number_of_entities(spark):
    todo = spark.range(3 * pii.ENTITIES_PER_TASK + 1).selectExpr("'ssn' AS kind", "lpad(id, 9, '1') AS canon", "0 AS round").coalesce(1)
    sizes = [len(p) for p in pii._drawn(todo, KEY).select("canon").rdd.glom().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.2 * pii.ENTITIES_PER_TASK
    assert pii._drawn(todo.limit(0), KEY).count() == 0
