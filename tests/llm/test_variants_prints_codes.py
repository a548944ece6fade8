"""Spelling variants, fingerprints and vector codes against brute force, with nulls, empty and very long inputs, ties, repeated
rows, empty tables and extra columns whose names clash with the operators' own."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from podium.llm import fingerprint, queries, spelling, vector_codes
from podium.llm.shared import LOWER, UPPER

FOLD = str.maketrans(UPPER, LOWER)
SCHEMA = "doc_id long, text string, word string, id long, run string, part int, n int, place double"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "w", 5, "r", 1, 2, 0.5) for i, t in rows], SCHEMA)


# ---- spelling variants

def counted(rows):
    counts = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants_expected(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts.get(form[w], 0)) for w, n in counts.items())


def variants(frame):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in frame.collect())


def test_spelling_variants(spark):
    rng = random.Random(3)
    stems = ["hello", "helloo", "hallo", "hullo", "hellos", "ello", "straße", "strasse", "strase", "élève", "eleve", "aaaaa", "aaaaaa", "aaaaaaa", "abababa",
             "bababab", "tree", "trees", "threes", "x×y÷zz", "Letter", "LETTER", "lettr", "etter", "letters"]
    stems += ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(stems, weights=[4 ** (k % 5) for k in range(len(stems))], k=200))) for i in range(40)]
    rows += [(None, "hello hello,hello"), (100, None), (101, ""), (102, " \n 123 "), (103, "trees " * 5000), (3, rows[3][1]), (3, rows[3][1]),
             (104, "wörter Ünique üniqueĀünique")]
    got = spelling.spelling_variants(docs(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    expected = variants_expected(counted(rows))
    assert variants(got) == expected
    assert any(f and f != r for _, f, r, *_ in expected) and any(k > 5 for *_, k, _ in expected)


def test_spelling_deletes_a_code_point_by_checksum(spark):
    rows = [(i, f"commonword{'abcdefgh'[i % 8]}") for i in range(2000)]
    got = {r.word: r.n for r in spelling.altered_runs(docs(spark, rows)).groupBy("word").count().withColumnRenamed("count", "n").collect()}
    expected = collections.Counter()
    for i, t in rows:
        h = zlib.crc32(f"{i}:{t}".encode())
        expected[t[:h % len(t)] + t[h % len(t) + 1:] if h % 97 == 0 else t] += 1
    assert got == expected and len(got) > 8


def test_spelling_long_chain_and_empty(spark):
    chain = [("z" * k + "a" * (9 - k), 3 * 2 ** k) for k in range(9)]
    got = {r.word: r.root for r in spelling.group_variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(got.values()) == {"z" * 8 + "a"}
    assert spelling.spelling_variants(docs(spark, [])).collect() == []
    assert spelling.spelling_variants(docs(spark, [(1, None)])).collect() == []


# ---- fingerprints

def plain_chunks(text):
    """Cuts found one code point after the other."""
    gear = lambda c: (lambda x: ((x ^ x >> 15) * 0x85EBCA77 & 0xFFFFFFFF) >> 16)(ord(c) * 0x9E3779B1 & 0xFFFFFFFF)
    out, at, h = [], 0, 0
    for k, c in enumerate(text):
        h = (2 * h + gear(c)) & 0xFFFF
        size = k + 1 - at
        bits = fingerprint.HARD if size < fingerprint.NORMAL else fingerprint.EASY
        if (size >= fingerprint.LEAST and h >> (16 - bits) == 0) or size == fingerprint.MOST:
            out.append(text[at:k + 1])
            at = k + 1
    return out + ([text[at:]] if at < len(text) else [])


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäß😀") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_chunks():
    rng = random.Random(1)
    for text in ["", "a", "a" * 7, "a" * 8, "a" * 9, "a" * 5000, "ab" * 700, *(prose(rng, n) for n in (1, 3, 20, 400, 3000))]:
        assert fingerprint.chunks(text) == plain_chunks(text)
        assert "".join(fingerprint.chunks(text)) == text
    sizes = [len(c) for c in fingerprint.chunks(prose(rng, 20_000))]
    assert 20 < np.mean(sizes) < 35 and max(sizes) <= fingerprint.MOST


def test_containment_is_measured_wherever_text_stands():
    rng = random.Random(2)
    a, b = prose(rng, 500), prose(rng, 500)
    of = fingerprint.fingerprint
    assert fingerprint.contained(of(a), of(b)) == 0
    assert fingerprint.contained(of(a), of(b + a + b)) > 0.97
    k = len(a) // 3
    assert abs(fingerprint.contained(of(a), of(b + a[k:])) - 2 / 3) < 0.03
    assert fingerprint.contained(of(a), of(a[:k] + "!" + a[k:])) > 0.95
    assert fingerprint.read(fingerprint.written(of(a))) == of(a)
    assert fingerprint.contained({}, {}) == 1 and fingerprint.contained({}, of(a)) == 0 and fingerprint.contained(of(a), {}) == 0


def expected_prints(rows):
    """rows with distinct ids"""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        changed = t[:len(t) - half] + following[:half]
        own, other, nxt = (fingerprint.fingerprint(x) for x in (t, changed, following))
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), fingerprint.written(own), fingerprint.written(other),
                    fingerprint.contained(own, other), fingerprint.contained(own, nxt)))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_with_next(spark, partitions):
    rng = random.Random(4)
    rows = [(rng.randrange(-10**9, 10**9), prose(rng, rng.randrange(1, 80))) for _ in range(60)]
    rows += [(7, None), (6, ""), (5, "x"), (4, prose(rng, 30_000)), (3, "same text in both"), (2, "same text in both"), (None, "no id"), (2**62, "😀ü\x00")]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = fingerprint.with_next(docs(spark, rows).repartition(5))
        found = sorted(map(tuple, got.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert found == expected_prints(rows)
    assert next(r for r in found if r[0] == 3)[-1] == 1.0


def test_with_next_repeated_and_few_rows(spark):
    rows = [(1, "one text"), (1, "one text"), (1, "another text"), (1, None), (None, None), (None, "b")]
    got = fingerprint.with_next(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t or "")) for i, t in rows)
    assert len({r.fingerprint for r in got if r.n_chars == 8}) == 1
    single = fingerprint.with_next(docs(spark, [(1, "abcdefgh")])).collect()
    assert [(r.n_chars, r.near_next) for r in single] == [(8, 1.0)]
    assert fingerprint.with_next(docs(spark, [])).collect() == []
    plain = fingerprint.fingerprints(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in plain) == sorted((str(i), fingerprint.written(fingerprint.fingerprint(t))) for i, t in rows)


# ---- vector codes

VECTORS = "vec_id long, embedding array<float>, label int, id string, code int, points double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1, 0.5) for i, v, y in rows], VECTORS)


def codes_expected(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [int(np.floor(4096 * float(np.float32(x)))) for x in v], y) for i, v, y in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[k * width:(k + 1) * width]) for k in range(parts)] for _, v, _ in kept]
    books = [[c[k] for c in cut[:entries]] for k in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda a, book: min(range(len(book)), key=lambda e: (dist(a, book[e]), e))
    for _ in range(rounds):
        for k in range(parts):
            held = collections.defaultdict(list)
            for c in cut:
                held[nearest(c[k], books[k])].append(c[k])
            for e, members in held.items():
                books[k][e] = tuple(sum(x) // len(members) for x in zip(*members))
    out, by_label = [], collections.Counter()
    for (i, _, y), c in zip(kept, cut):
        code = [nearest(c[k], books[k]) for k in range(parts)]
        error = sum(dist(c[k], books[k][e]) for k, e in enumerate(code))
        by_label[y] += error
        out.append((i, "".join(f"{e:02x}" for e in code), error, y))
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((i, c, e, by_label[y]) for i, c, e, y in out), key=str), hashlib.sha256(flat.encode()).hexdigest()


def digest(books):
    return hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()


def some_vectors(n, dim=16, seed=6):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.5, (5, dim))
    rows = [(int(i) + 20, [float(x) for x in np.float32(middles[i % 5] + rng.normal(0, 0.02, dim))], None if i % 4 == 0 else int(i % 3)) for i in range(n)]
    rows += [(k, rows[min(9, n - 1)][1], 1) for k in range(12)]  # one vector many times, among the first entries as well
    rows += [(900, None, 1), (901, [], 1), (902, [None] * dim, 2), (903, [float("nan")] * dim, 2), (904, [float("inf")] + [0.0] * (dim - 1), 2),
             (905, [0.0] * dim, 7), (905, [0.0] * dim, 7), (None, [1.0] * dim, None), (906, [-0.0001] * dim, 7), (907, [1e-30] * dim, 7)]
    return rows


@pytest.mark.parametrize("n, dim", [(300, 16), (3, 8), (40, 24)])
def test_vector_codes(spark, n, dim):
    rows = some_vectors(n, dim)
    out, books = vector_codes.encode(vectors(spark, rows).repartition(3))
    assert out.columns == ["vec_id", "code", "error", "label_error"]
    expected, sha = codes_expected(rows)
    assert sorted(map(tuple, out.collect()), key=str) == expected
    assert digest(books) == sha


def test_vector_codes_defined_cases(spark):
    out, books = vector_codes.encode(vectors(spark, []))
    assert out.collect() == [] and books.size == 0
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [0.5] * 16, 1)]  # the last has another length
    out, books = vector_codes.encode(vectors(spark, rows))
    assert sorted(r.vec_id for r in out.collect()) == [1, 2] and books.shape == (8, 2, 1)
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.encode(vectors(spark, [(1, [1.0] * 9, 1)]))


def test_cover_tree():
    rng = np.random.default_rng(8)
    middles = rng.integers(-4000, 4000, (16, 4))
    points = np.concatenate([middles[rng.integers(0, 16, 2000)] + rng.integers(-30, 30, (2000, 4)), np.repeat(middles[:1], 500, 0)])
    tree, order = vector_codes.cover_tree(points)
    assert (tree.points == points[order]).all() and sorted(order) == list(range(len(points)))
    for k in range(len(tree.start)):
        inside = tree.points[tree.start[k]:tree.end[k]]
        far = np.sqrt(((inside - tree.points[tree.centre[k]]) ** 2).sum(1).max())
        assert tree.start[k] <= tree.centre[k] < tree.end[k] and far <= tree.radius[k] <= far * (1 + 1e-9)
        below = range(tree.child[k], tree.child[k] + tree.children[k])
        if below:  # children follow each other, fill the node, and the first keeps its centre
            assert [tree.start[c] for c in below] == [tree.start[k], *(tree.end[c] for c in list(below)[:-1])] and tree.end[below[-1]] == tree.end[k]
            assert (tree.points[tree.centre[below[0]]] == tree.points[tree.centre[k]]).all()
    start, end, entry, place, one, tested = vector_codes.assign(tree, middles)
    nearest = ((points[order][:, None] - middles[None]) ** 2).sum(2).argmin(1)
    got = np.full(len(points), -1)
    for s, e, x in zip(start, end, entry):
        got[s:e] = x
    got[place] = one
    assert (got == nearest).all() and tested < len(points) / 10  # whole clusters go at once


def test_queries_registered():
    assert {"op11_spelling_variants", "op12_fingerprint", "op13_vector_codes"} <= set(queries.QUERIES)
