"""Vector code compression by product quantisation, its codebooks fitted by cover-tree Lloyd rounds.

1. Components become integers ``floor(scale * x)``; a vector is cut into ``parts`` equal parts, each coded by the index of
   its nearest codebook entry.  All sums and comparisons that decide are on integers, so results do not depend on how rows
   lie in partitions.
2. Each task cuts its own partition into chunks of ``CHUNK`` vectors and builds one cover tree per chunk and part: a
   node's children cover its points within a radius that halves from level to level, each starts at a point that no
   earlier child covers, and the first child keeps its parent's centre.  Points lie in tree order, so that a node is a
   range and its sum is the difference of two cumulative sums.  The trees are written once; every round reads them.
3. In a round a node whose centre is nearer to one entry than to any other by more than twice its radius goes to that entry
   whole (triangle inequality), with its sum and count.  Other nodes descend; leaves that are still ambiguous compare their
   points exactly, ties to the lower index.  Tasks add up what they hold, so a round moves one row per entry
   component and task.
4. The last pass assigns once more and returns codes and squared distances.

Collected to the driver: the ``entries`` first vectors and, each round, one sum per component of every entry.

Defined cases: vectors that are null or empty or hold null or non-finite components are dropped, as are those of another
length than the first kept id's; that length must be a multiple of ``parts``.  Null ids come last in the order of ids, rows of
equal ids are ordered by their vectors, and each comes out.  With fewer rows than ``entries`` there are that many
entries; entries with equal components never win over the first of them and stay as they are.  An empty table gives no rows.
Components beyond +-32768 at the scale of 4096 (2^27 as integers) end the query with an error, since squared distances
could pass 64 bits.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.shared import Scratch, ship

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
CHUNK = 2048  # vectors a tree is built over
LEAF = 8  # nodes of so many points have no children
LARGEST = 1 << 27


@dataclass
class Tree:
    """Nodes in breadth-first order; ``start`` .. ``end`` are places in tree order, ``centre`` one of them."""
    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    centre: np.ndarray
    child: np.ndarray
    children: np.ndarray
    radius: np.ndarray


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the given ranges."""
    return np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[Tree, np.ndarray]:
    """The tree over the rows of ``points`` and the row that stands at each place in tree order."""
    p = points.astype(np.float64)
    n = len(p)
    apart = lambda a, b: np.einsum("ij,ij->i", p[a] - p[b], p[a] - p[b])
    of = np.zeros(n, np.int64)  # the deepest node of each point
    parent, centre, size, depth = [np.array([-1])], [np.array([0])], [np.array([n])], [np.array([0])]
    far = [np.array([apart(np.arange(n), np.zeros(n, int)).max()])]
    made, open_nodes = 1, np.array([0])
    cover = 2.0 ** np.ceil(np.log2(max(np.sqrt(far[0][0]), 1.0)))
    level = 0
    while len(open_nodes):
        cover /= 2
        flat = [np.concatenate(x) for x in (far, size, centre, depth)]
        wide = np.zeros(made, bool)
        wide[open_nodes] = flat[0][open_nodes] > cover * cover
        rows = np.flatnonzero(wide[of])
        rows = rows[np.argsort(of[rows], kind="stable")]
        node, first = of[rows], True
        fresh = [open_nodes[~wide[open_nodes]]]
        while len(rows):
            at = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            group = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(rows)]))
            middle = flat[2][node[at]] if first else rows[at]
            d = apart(rows, middle[group])
            near = d <= cover * cover
            ids = made + np.arange(len(at))
            of[rows[near]] = ids[group[near]]
            parent.append(node[at])
            centre.append(middle)
            depth.append(flat[3][node[at]] + 1)
            size.append(np.bincount(group[near], minlength=len(at)))
            far.append(np.maximum.reduceat(np.where(near, d, 0.0), at))
            fresh.append(ids)
            made += len(at)
            rows, node, first = rows[~near], node[~near], False
        sizes, fars = np.concatenate(size), np.concatenate(far)
        open_nodes = np.concatenate(fresh)
        open_nodes = open_nodes[(fars[open_nodes] > 0) & (sizes[open_nodes] > leaf)]
        level += 1
    parent, centre, size, depth, far = (np.concatenate(x) for x in (parent, centre, size, depth, far))
    # places: children follow each other inside their parent's range
    start = np.zeros(made, np.int64)
    for k in range(1, depth.max() + 1):
        ids = np.flatnonzero(depth == k)
        ids = ids[np.argsort(parent[ids], kind="stable")]
        at = np.flatnonzero(np.r_[True, parent[ids][1:] != parent[ids][:-1]])
        before = np.cumsum(size[ids]) - size[ids]
        start[ids] = start[parent[ids]] + before - np.repeat(before[at], np.diff(np.r_[at, len(ids)]))
    order = np.argsort(start[of], kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    by = np.lexsort((start, depth))
    number = np.empty(made, np.int64)
    number[by] = np.arange(made)
    children = np.bincount(parent[1:], minlength=made)[by] if made > 1 else np.zeros(made, np.int64)
    child = 1 + np.cumsum(children) - children
    tree = Tree(points[order], start[by], (start + size)[by], place[centre[by]], child, children, np.sqrt(far[by]) * (1 + 1e-12))
    return tree, order


def _squares(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    d = points[:, None, :] - book[None, :, :]
    return np.einsum("ijk,ijk->ij", d, d)


def assign(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(start, end, entry) of the subtrees that go whole, (place, entry) of the points compared one by one, and how many
    distances to the whole codebook were computed."""
    whole, single = [], []
    nodes, tested = np.array([0]), 0
    while len(nodes):
        d = _squares(tree.points[tree.centre[nodes]], book)
        tested += len(nodes)
        best = d.argmin(1)
        root = np.sqrt(d.astype(np.float64))
        nearest = root[np.arange(len(nodes)), best]
        root[np.arange(len(nodes)), best] = np.inf
        radius = tree.radius[nodes]
        sure = (radius == 0) | (root.min(1) - nearest > 2 * radius * (1 + 1e-9) + 1e-5)
        whole.append((tree.start[nodes[sure]], tree.end[nodes[sure]], best[sure]))
        rest = nodes[~sure]
        leaves = rest[tree.children[rest] == 0]
        places = _ranges(tree.start[leaves], tree.end[leaves] - tree.start[leaves])
        if len(places):
            single.append((places, _squares(tree.points[places], book).argmin(1)))
            tested += len(places)
        inner = rest[tree.children[rest] > 0]
        nodes = _ranges(tree.child[inner], tree.children[inner])
    start, end, entry = (np.concatenate(x) for x in zip(*whole))
    place, one = (np.concatenate(x) for x in zip(*single)) if single else (np.empty(0, int), np.empty(0, int))
    return start, end, entry, place, one, tested


def moments(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, sum) of the points of every entry: of whole subtrees from the cumulative sums."""
    start, end, entry, place, one, _ = assign(tree, book)
    until = np.zeros((len(tree.points) + 1, tree.points.shape[1]), np.int64)
    np.cumsum(tree.points, axis=0, out=until[1:])
    count, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    np.add.at(count, entry, end - start)
    np.add.at(total, entry, until[end] - until[start])
    np.add.at(count, one, 1)
    np.add.at(total, one, tree.points[place])
    return count, total


def codes(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every point, in tree order."""
    start, end, entry, place, one, _ = assign(tree, book)
    out = np.empty(len(tree.points), np.int64)
    out[_ranges(start, end - start)] = np.repeat(entry, end - start)
    out[place] = one
    d = tree.points - book[out]
    return out, np.einsum("ij,ij->i", d, d)


def _packed(ints: np.ndarray, parts: int) -> dict[str, object]:
    """A chunk's trees as the columns of one row."""
    width = ints.shape[1] // parts
    trees, orders = zip(*(cover_tree(ints[:, k * width:(k + 1) * width]) for k in range(parts)))
    return {"rows": len(ints), "width": width,
            "places": np.stack(orders).astype(np.int32).tobytes(),
            "points": np.stack([t.points for t in trees]).astype(np.int32).tobytes(),
            "sizes": [len(t.start) for t in trees],
            "nodes": b"".join(np.stack([t.start, t.end, t.centre, t.child, t.children]).astype(np.int32).tobytes() for t in trees),
            "radii": b"".join(t.radius.tobytes() for t in trees)}


TREES = [("rows", pa.int32(), "int"), ("width", pa.int32(), "int"), ("places", pa.binary(), "binary"), ("points", pa.binary(), "binary"),
         ("sizes", pa.list_(pa.int32()), "array<int>"), ("nodes", pa.binary(), "binary"), ("radii", pa.binary(), "binary")]


def _unpacked(row: dict[str, object]) -> Iterator[tuple[Tree, np.ndarray]]:
    n, width, parts = row["rows"], row["width"], len(row["sizes"])
    orders = np.frombuffer(row["places"], np.int32).reshape(parts, n)
    points = np.frombuffer(row["points"], np.int32).reshape(parts, n, width).astype(np.int64)
    nodes, radii, at = np.frombuffer(row["nodes"], np.int32), np.frombuffer(row["radii"], np.float64), 0
    for k, m in enumerate(row["sizes"]):
        yield Tree(points[k], *nodes[5 * at:5 * (at + m)].reshape(5, m).astype(np.int64), radii[at:at + m]), orders[k]
        at += m


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = vectors.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(_finite(F.col("vector")))


def fit_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = None,
              parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(rows of ``id, label, code, error``, the final codebooks as integers by part, entry and component)."""
    if entries > 256:
        raise ValueError("codes hold two hex digits a part: at most 256 entries")
    spark = vectors.sparkSession
    ship(spark)
    tmp = Scratch(spark, "codes")
    kept = _kept(vectors, id_col, vector_col, label_col)
    length = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).select(F.size("vector").alias("n")).collect()
    dim = length[0].n if length else 0
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("vector") == dim)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    book = np.array([_integers(np.array(r.vector), scale) for r in first], np.int64).reshape(len(first), parts, dim // parts).transpose(1, 0, 2)

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    fields = ", ".join(f"{name} {kind}" for name, _, kind in TREES)

    def chunk(ids: pa.Array, labels: pa.Array, ints: np.ndarray) -> pa.RecordBatch:
        row = _packed(ints, parts)
        whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        return pa.RecordBatch.from_arrays([whole(ids), whole(labels), *(pa.array([row[name]], kind) for name, kind, _ in TREES)],
                                          names=["ids", "labels", *(name for name, _, _ in TREES)])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = 0
            while at < len(batch):  # chunks reach over batches
                take = min(CHUNK - sum(map(len, held)), len(batch) - at)
                held.append(batch.slice(at, take))
                at += take
                if sum(map(len, held)) == CHUNK:
                    yield joined(held)
                    held = []
        if held:
            yield joined(held)

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        column = lambda name: table[name].combine_chunks() if table[name].num_chunks != 1 else table[name].chunk(0)
        return chunk(column("id"), column("label"), _integers(column("vector").flatten().to_numpy(zero_copy_only=False), scale).reshape(-1, dim))

    trees = tmp.write(kept.mapInArrow(build, f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, {fields}"))

    for _ in range(rounds):
        def add(batches: Iterator[pa.RecordBatch], book=book) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(book.shape[:2], np.int64), np.zeros(book.shape, np.int64)
            for batch in batches:
                for row in _rows(batch):
                    for k, (tree, _) in enumerate(_unpacked(row)):
                        c, t = moments(tree, book[k])
                        count[k] += c
                        total[k] += t
            part, entry, at = np.nonzero(np.broadcast_to(count[:, :, None], total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, entry, at, count[part, entry], total[part, entry, at])],
                                             names=["part", "entry", "at", "n", "total"])

        sums = (trees.drop("ids", "labels").mapInArrow(add, "part long, entry long, at long, n long, total long")
                .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total")))
        book = book.copy()
        for r in sums.collect():
            book[r.part, r.entry, r.at] = int(r.total) // r.n

    def finish(batches: Iterator[pa.RecordBatch], book=book) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(_rows(batch)):
                code = np.empty((row["rows"], len(row["sizes"])), np.uint8)
                error = np.zeros(row["rows"], np.int64)
                for k, (tree, order) in enumerate(_unpacked(row)):
                    code[order, k], d = codes(tree, book[k])
                    error[order] += d
                text = code.tobytes().hex()
                step = 2 * code.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch["ids"].slice(i, 1).flatten(), batch["labels"].slice(i, 1).flatten(),
                     pa.array([text[j:j + step] for j in range(0, len(text), step)], pa.string()), pa.array(error)],
                    names=["id", "label", "code", "error"])

    out = trees.mapInArrow(finish, f"id {kinds['id']}, label {kinds['label']}, code string, error long")
    return out, book


def _rows(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
    for i in range(len(batch)):
        yield {name: batch[name][i].as_py() for name, _, _ in TREES}


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(scale * x)
    if len(out) and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST / scale:g}: squared distances could pass 64 bits")
    return out.astype(np.int64)


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           **parameters: int) -> tuple[DataFrame, np.ndarray]:
    """(rows of ``id, code, error, label_error``, codebooks): the error is also summed over equal labels, nulls together."""
    out, book = fit_codes(vectors, id_col, vector_col, label_col, **parameters)
    out = Scratch(vectors.sparkSession, "coded").write(out)
    by_label = out.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    out = out.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left")
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error"), book
