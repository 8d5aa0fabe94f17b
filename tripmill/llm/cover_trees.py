"""Vector codes by product quantization, its codebooks learnt by Lloyd rounds over cover trees.

A vector's components become integers, and the vector is cut into ``PARTS`` consecutive parts. A part's code is
the index of the nearest of ``ENTRIES`` entries of that position's codebook. The codebooks come from rounds that
assign all parts to their nearest entries and move every entry to the mean of its parts.

Blocks of vectors get one cover tree for each part position, once, where the vectors are: a node covers its
points within a radius around one of them, its children do so with half the reach and stand apart from each other by more
than that. Points are kept in tree order, so a node's points are a range and its sum is a difference of two
cumulative sums. In a round a node whose second nearest entry is farther than its nearest by more than twice its
radius goes to that entry as a whole, by the triangle inequality; others are taken apart, and points are compared
one by one only in leaves that stay ambiguous. Blocks with their trees are written once; a round reads them and sends
one row of sums for each entry and component. Nothing but these sums and the codebooks reaches the driver.

Everything that decides is exact integer arithmetic: ties go to the lower index. Vectors that are NULL or hold NULL
or non-finite components are dropped. Vectors of different lengths have codebooks of their own (for each length, 128
entries at the driver); a length that 8 does not divide is cut into parts that differ by one component at most. A
codebook starts from the smallest vec_ids, NULL ids last, ties by components; with fewer than ``ENTRIES`` vectors it
has as many entries. Repeated rows count as often as they stand there. An empty table gives an empty result; further
columns are ignored. Components too large for squared distances of 64 bits are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import shuffle_tasks, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components of the vectors of one block at most (but one vector at least), and points of a leaf.
BLOCK_COMPONENTS, LEAF_POINTS = 1 << 19, 24
_MARGIN = 1e-9

#: (length of vectors) -> for each part position the entries, one row each.
Codebooks = dict[int, list[np.ndarray]]


def part_ranges(size: int) -> list[tuple[int, int]]:
    edges = [i * size // PARTS for i in range(PARTS + 1)]
    return list(zip(edges, edges[1:], strict=False))


def squared_distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``points`` to all of ``entries``."""
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * points.shape[1] * int(largest) ** 2 < 1 << 52:  # whole numbers that doubles hold exactly
        x, c = points.astype(np.float64), entries.astype(np.float64)
        found = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        return found.astype(np.int64)
    return np.stack([((points - c) ** 2).sum(axis=1) for c in entries], axis=1)


class CoverTree:
    """Nodes in order of depth; each covers the points ``order[start:end]`` within ``radius`` of its center."""

    FIELDS = ("order", "start", "end", "center", "child", "children", "radius")

    def __init__(self, **arrays: np.ndarray) -> None:
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def of(cls, points: np.ndarray) -> CoverTree:
        x = points.astype(np.float64)
        order = np.arange(len(x), dtype=np.int32)
        start, end, center, reach = [0], [len(x)], [0], [np.inf]
        child, children, radius = [], [], []
        node = 0
        while node < len(start):
            own = order[start[node] : end[node]].copy()
            away = np.sqrt(((x[own] - x[center[node]]) ** 2).sum(axis=1))
            radius.append(float(away.max()) * (1 + _MARGIN))
            child.append(len(start))
            if len(own) > LEAF_POINTS and radius[-1] > 0:
                half = min(reach[node], radius[-1]) / 2
                at = start[node]
                # The node's own center is a center below it too; the first point left out is the next one.
                heart, near = center[node], away <= half
                while True:
                    taken = own[near]
                    order[at : at + len(taken)] = taken
                    start.append(at)
                    at += len(taken)
                    end.append(at)
                    center.append(heart)
                    reach.append(half)
                    own = own[~near]
                    if not len(own):
                        break
                    heart = int(own[0])
                    near = np.sqrt(((x[own] - x[heart]) ** 2).sum(axis=1)) <= half
            children.append(len(start) - child[-1])
            node += 1
        whole = {"start": start, "end": end, "center": center, "child": child, "children": children}
        arrays = {name: np.array(values, dtype=np.int32) for name, values in whole.items()}
        return cls(order=order, radius=np.array(radius), **arrays)

    def ranges(self, centers: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Nodes that together cover all points once: with their entry each, or without one if it is not decided.

        ``centers`` are the points of the nodes' centers.
        """
        c = entries.astype(np.float64)
        nodes = np.zeros(1, dtype=np.int64)
        while len(nodes):
            away = np.sqrt(((centers[nodes][:, None, :] - c) ** 2).sum(axis=2))
            nearest = away.argmin(axis=1)
            if len(c) > 1:
                first, second = np.partition(away, 1, axis=1)[:, :2].T
                # A point of the node is nearer to the center than the radius: both distances change by that at most.
                decided = second - first > 2 * self.radius[nodes] + _MARGIN * (1 + second)
            else:
                decided = np.ones(len(nodes), dtype=bool)
            yield nodes[decided], nearest[decided]
            nodes = nodes[~decided]
            leaf = self.children[nodes] == 0
            yield nodes[leaf], None
            nodes = nodes[~leaf]
            counts = self.children[nodes]
            within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            nodes = np.repeat(self.child[nodes], counts) + within


def _expanded(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    counts = ends - starts
    return np.repeat(starts, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def round_sums(tree: CoverTree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each entry the sum of its points (in tree order) and, in the last column, their number."""
    sums = np.zeros((len(entries), points.shape[1] + 1), dtype=np.int64)
    counted = np.concatenate([points, np.ones((len(points), 1), np.int64)], axis=1)
    upto = np.concatenate([np.zeros((1, counted.shape[1]), np.int64), np.cumsum(counted, axis=0)])
    for nodes, nearest in tree.ranges(points_of_centers(tree, points), entries):
        if nearest is not None:
            np.add.at(sums, nearest, upto[tree.end[nodes]] - upto[tree.start[nodes]])
        elif len(nodes):
            own = _expanded(tree.start[nodes], tree.end[nodes])
            np.add.at(sums, squared_distances(points[own], entries).argmin(axis=1), counted[own])
    return sums


def nearest_entries(tree: CoverTree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of every point, in tree order."""
    labels = np.empty(len(points), dtype=np.int64)
    for nodes, nearest in tree.ranges(points_of_centers(tree, points), entries):
        own = _expanded(tree.start[nodes], tree.end[nodes])
        if nearest is not None:
            labels[own] = np.repeat(nearest, tree.end[nodes] - tree.start[nodes])
        elif len(nodes):
            labels[own] = squared_distances(points[own], entries).argmin(axis=1)
    return labels


def points_of_centers(tree: CoverTree, points: np.ndarray) -> np.ndarray:
    """The nodes' centers, from points in tree order."""
    place = np.empty(len(points), dtype=np.int64)
    place[tree.order] = np.arange(len(points))
    return points[place[tree.center]].astype(np.float64)


_TREE = pa.struct([(name, pa.binary()) for name in CoverTree.FIELDS])
_TREE_SQL = f"struct<{', '.join(f'{name}: binary' for name in CoverTree.FIELDS)}>"


def _stored(tree: CoverTree) -> dict[str, bytes]:
    return {name: getattr(tree, name).tobytes() for name in CoverTree.FIELDS}


def _loaded(stored: dict[str, bytes]) -> CoverTree:
    kinds = {"radius": np.float64}
    return CoverTree(**{name: np.frombuffer(data, kinds.get(name, np.int32)) for name, data in stored.items()})


def _blocks(kept: DataFrame) -> DataFrame:
    """One row per block of vectors of a length: ids, labels, components, and a tree for each part position."""
    fields = "size int, vec_ids array<long>, labels array<{label}>, points binary, trees array<{tree}>"
    schema = fields.format(label=kept.schema["label"].dataType.simpleString(), tree=_TREE_SQL)

    def block(size: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows).combine_chunks()
        n = whole.num_rows
        flat = whole.column("parts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        largest = max(int(flat.max(initial=0)), -int(flat.min(initial=0)))
        if 4 * max(size, 1) * largest**2 >= 1 << 62:
            raise ValueError(f"vectors of {size} components up to {largest} give distances beyond 64 bits")
        points = flat.reshape(n, size)
        trees = [_stored(CoverTree.of(points[:, a:b])) for a, b in part_ranges(size)]
        ends = pa.array([0, n], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, whole.column(c).combine_chunks()) for c in ("vec_id", "label")]
        columns = [pa.array([size], pa.int32()), *lists, pa.array([points.tobytes()], pa.binary()), pa.array([trees], pa.list_(_TREE))]
        return pa.RecordBatch.from_arrays(columns, names=["size", "vec_ids", "labels", "points", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                most = max(BLOCK_COMPONENTS // max(size, 1), 1)
                own = batch.filter(pa.array(sizes == size))
                held = waiting.setdefault(size, [])
                while own.num_rows:
                    room = most - sum(b.num_rows for b in held)
                    held.append(own.slice(0, room))
                    own = own.slice(room)
                    if sum(b.num_rows for b in held) == most:
                        yield block(size, held)
                        held.clear()
        for size, held in waiting.items():
            if held:
                yield block(size, held)

    return kept.select("size", "vec_id", "label", "parts").mapInArrow(run, schema)


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list[tuple[CoverTree, np.ndarray]]]]:
    """For each block its length of vectors, its row, and for each position its tree and points in tree order."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            size = row.column("size")[0].as_py()
            trees = [_loaded(t) for t in row.column("trees")[0].as_py()]
            points = np.frombuffer(row.column("points")[0].as_buffer(), np.int64).reshape(len(trees[0].order), size)
            places = zip(trees, part_ranges(size), strict=True)
            yield size, row, [(tree, points[tree.order, a:b]) for tree, (a, b) in places]


def first_entries(kept: DataFrame) -> Codebooks:
    """The parts of the vectors of smallest id, for each length; a task sends ``ENTRIES`` rows of a length at most."""
    order = Window.partitionBy("size").orderBy(F.asc_nulls_last("vec_id"), "parts")
    rows = kept.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= ENTRIES)
    found: dict[int, list[list[int]]] = {}
    for row in rows.select("size", "parts", "__rank").orderBy("size", "__rank").collect():
        found.setdefault(row.size, []).append(row.parts)
    books = {}
    for size, vectors in found.items():
        whole = np.array(vectors, dtype=np.int64).reshape(len(vectors), size)
        books[size] = [whole[:, a:b] for a, b in part_ranges(size)]
    return books


def next_entries(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """One round: all parts assigned, every entry moved to the rounded-down mean of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for size, _, parts in _of_blocks(batches):
            for number, (tree, points) in enumerate(parts):
                found = round_sums(tree, points, books[size][number])
                totals[size, number] = totals.get((size, number), 0) + found
        for (size, number), sums in totals.items():
            cells = np.arange(sums.size)
            columns = [np.full(sums.size, size), np.full(sums.size, number), cells, sums.ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                names=["size", "part", "cell", "v"],
            )

    cells = blocks.mapInArrow(run, "size int, part int, cell long, v long")
    moved = {size: [entries.copy() for entries in parts] for size, parts in books.items()}
    summed: dict[tuple[int, int], dict[int, int]] = {}
    for row in cells.groupBy("size", "part", "cell").agg(F.sum("v").alias("v")).collect():
        summed.setdefault((row.size, row.part), {})[row.cell] = row.v
    for (size, number), values in summed.items():
        entries = moved[size][number]
        width = entries.shape[1] + 1
        for e in range(len(entries)):
            count = values[e * width + width - 1]
            if count:
                entries[e] = [values[e * width + i] // count for i in range(width - 1)]
    return moved


def digest_of(entries: list[np.ndarray]) -> str:
    text = ",".join(str(v) for part in entries for v in part.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def encode(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of every vector."""
    digests = {size: digest_of(parts) for size, parts in books.items()}
    label = blocks.schema["labels"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, row, parts in _of_blocks(batches):
            n = len(parts[0][0].order)
            codes, errors = np.zeros((n, PARTS), dtype=np.int64), np.zeros(n, dtype=np.int64)
            for number, (tree, points) in enumerate(parts):
                entries = books[size][number]
                found = nearest_entries(tree, points, entries)
                codes[tree.order, number] = found
                errors[tree.order] += ((points - entries[found]) ** 2).sum(axis=1)
            texts = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    row.column("vec_ids").flatten(),
                    row.column("labels").flatten(),
                    pa.array(texts, pa.string()),
                    pa.array(errors),
                    pa.array([digests[size]] * n, pa.string()),
                ],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"],
            )

    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("label", label),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
            T.StructField("codebooks_sha256", T.StringType()),
        ]
    )
    return blocks.mapInArrow(run, schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors summed over the rows of a label, NULLs together.

    A label with more rows than a task should have is dealt over all tasks, and its sum to each of them. There are
    fewer such labels than tasks; they are what the driver fetches.
    """
    tasks = shuffle_tasks(coded.sparkSession)
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    total = sums.agg(F.sum("n").alias("n"))
    crowded = sums.where(F.col("n") * tasks > total.scalar()).select("label").collect()
    known = [row.label for row in crowded if row.label is not None]
    is_crowded = F.col("label").isin(known) if known else F.lit(False)
    is_crowded = F.coalesce(is_crowded, F.lit(len(known) < len(crowded)))
    salted = coded.withColumn("__salt", F.when(is_crowded, F.pmod(F.xxhash64("vec_id", "code"), F.lit(tasks))).otherwise(0))
    copies = F.when(is_crowded, F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array(F.lit(0)))
    dealt = sums.select(F.col("label").alias("__label"), "label_error", F.explode(copies).alias("__copy"))
    same = F.col("label").eqNullSafe(F.col("__label")) & (F.col("__salt") == F.col("__copy"))
    return salted.join(dealt, same).select(*coded.columns, "label_error")


def product_codes(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of ``vectors`` (vec_id, embedding, label)."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"
    ).where(sound)
    kept = kept.select(
        F.size("embedding").alias("size"),
        "vec_id",
        "label",
        F.transform("embedding", lambda x: F.floor(x * SCALE)).alias("parts"),
    )
    blocks = written(_blocks(kept), "cover-trees")
    books = first_entries(kept)
    for _ in range(rounds):
        books = next_entries(blocks, books)
    coded = written(encode(blocks, books), "vector-codes")
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings."""
    return product_codes(table(spark, sf_dir, "embeddings"))
