"""Near-duplicate vectors within a label by cosine: tiles compared along principal axes.

Equal vectors of a label form a class; classes are compared. Two unit vectors with a cosine of at least t
differ by at most sqrt(2 - 2t) along any axis, so only neighbouring cells of a grid on the two leading
principal axes can hold links. Cells are cut into blocks of bounded size, and a tile is a pair of blocks. In a
tile products are summed over leading principal axes first; the rest of a product is at most the product of
the two suffix norms, so a pair is dropped as soon as it cannot reach t any more. Pairs that remain are decided
by the cosine of the vectors themselves in double precision. A tile gives each vector its number of links and
one edge to the smallest vector that it is tied to in the tile: pairs are never written out.

Vectors that are NULL, zero, or hold NULL or non-finite components, rows with a NULL label and vectors of
different lengths link with nothing. Rows with equal vec_id are vectors of their own that share a component;
rows with NULL vec_id are returned with no links and take no part. An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import components, table, tied, written

THRESHOLD = 0.98
BLOCK_ROWS = 1024
_STAGES = (8, 24)
_PAIRS_AT_ONCE = 1 << 15
_SLACK = 1e-9


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()).astype(
        np.float64
    ).reshape(-1, size)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the principal axes of the unit vectors, leading first.

    A task sends one matrix per vector length, and the driver gets their sum.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                rows = _matrix(batch.filter(pa.array(sizes == size)).column("embedding"), size)
                rows /= np.linalg.norm(rows, axis=1, keepdims=True)
                sums[size] = sums.get(size, 0) + rows.T @ rows
        cells = [(n, i, float(v)) for n, m in sums.items() for i, v in enumerate(m.ravel())]
        columns = list(zip(*cells, strict=True)) or [(), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["size", "cell", "v"]
        )

    found = vectors.select("size", "embedding").mapInArrow(moments, "size int, cell int, v double")
    summed = found.groupBy("size", "cell").agg(F.sum("v").alias("v")).groupBy("size")
    axes = {}
    for row in summed.agg(F.sort_array(F.collect_list(F.struct("cell", "v"))).v.alias("v")).collect():
        _, vectors_ = np.linalg.eigh(np.array(row.v).reshape(row.size, row.size))
        axes[row.size] = np.ascontiguousarray(vectors_[:, ::-1])
    return axes


def links_in_tile(x: np.ndarray, left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float) -> np.ndarray:
    """Index pairs (i of ``left``, j of ``right``) of rows of ``x`` whose cosine reaches ``threshold``."""
    norms = np.linalg.norm(x, axis=1)
    turned = (x / norms[:, None]) @ axes
    squares = np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1]
    suffix = np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], axis=1))
    size = x.shape[1]
    first = min(_STAGES[0], size)
    partial = turned[left][:, :first] @ turned[right][:, :first].T
    bound = partial + np.multiply.outer(suffix[left, first], suffix[right, first])
    i, j = np.nonzero(bound >= threshold - _SLACK)
    i, j = left[i], right[j]
    if np.array_equal(left, right):
        i, j = i[i < j], j[i < j]
    kept = []
    for at in range(0, len(i), _PAIRS_AT_ONCE):
        a, b = i[at : at + _PAIRS_AT_ONCE], j[at : at + _PAIRS_AT_ONCE]
        done, total = 0, np.zeros(len(a))
        for stop in (*(s for s in _STAGES if s < size), size):
            total += np.einsum("ij,ij->i", turned[a, done:stop], turned[b, done:stop])
            hopeful = total + suffix[a, stop] * suffix[b, stop] >= threshold - _SLACK
            a, b, total, done = a[hopeful], b[hopeful], total[hopeful], stop
        exact = np.einsum("ij,ij->i", x[a], x[b]) / (norms[a] * norms[b])
        kept.append(np.stack([a[exact >= threshold], b[exact >= threshold]], axis=1))
    return np.concatenate(kept) if kept else np.zeros((0, 2), dtype=np.int64)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = rows.where("sound").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("size", F.size("embedding")), "vector-classes")
    axes = spark.sparkContext.broadcast(principal_axes(classes))
    width = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-6) + 1e-9

    @F.pandas_udf("x int, y int")
    def cell(embedding: pd.Series) -> pd.DataFrame:
        found = np.zeros((len(embedding), 2), dtype=np.int64)
        for n, v in enumerate(embedding):
            lead = (v / np.linalg.norm(v)) @ axes.value[len(v)][:, :2]
            found[n, : len(lead)] = np.floor(lead / width)
        return pd.DataFrame({"x": found[:, 0], "y": found[:, 1]})

    placed = classes.withColumn("cell", cell("embedding")).select("*", "cell.x", "cell.y").drop("cell")
    where = ["label", "size", "x", "y"]
    blocks = F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")
    cells = written(placed.groupBy(where).agg(blocks), "vector-cells")
    steps = F.array([F.lit(i) for i in (-1, 0, 1)])
    near = (
        cells.select("label", "size", F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("blocks").alias("nb"))
        .withColumn("dx", F.explode(steps))
        .withColumn("dy", F.explode(steps))
        .select("label", "size", (F.col("nx") + F.col("dx")).alias("x"), (F.col("ny") + F.col("dy")).alias("y"), "nx", "ny", "nb")
    )
    around = near.groupBy(where).agg(F.collect_list(F.struct("nx", "ny", "nb")).alias("near"))  # at most nine
    around = around.join(cells, where)
    mine = F.struct(F.col("x"), F.col("y"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("b"))
    others = F.flatten(
        F.transform(
            "near",
            lambda n: F.transform(
                F.sequence(F.lit(0), n.nb - 1), lambda b: F.struct(n.nx.alias("x"), n.ny.alias("y"), b.alias("b"))
            ),
        )
    )
    dealt = (
        placed.join(around, where)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(others))
        .select(
            "label",
            "size",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            (F.col("mine") <= F.col("other")).alias("in_low"),
            "rep",
            "copies",
            "embedding",
        )
    )

    def compare(batch: pa.Table) -> pa.Table:
        size = batch.column("size")[0].as_py()
        ids, copies = batch.column("rep").to_numpy(), batch.column("copies").to_numpy()
        order = np.argsort(ids, kind="stable")
        x = _matrix(batch.column("embedding"), size)[order]
        ids, copies = ids[order], copies[order]
        same = batch.column("low")[0].as_py() == batch.column("high")[0].as_py()
        in_low = np.asarray(batch.column("in_low"))[order]
        left = np.arange(len(ids)) if same else np.flatnonzero(in_low)
        right = left if same else np.flatnonzero(~in_low)
        pairs = links_in_tile(x, left, right, axes.value[size], threshold)
        n = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(ids)) + np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(ids))
        some = np.flatnonzero(n)
        return pa.table(
            {"rep": ids[some], "n": n[some].astype(np.int64), "root": ids[tied(len(ids), pairs)[some]]}
        )

    tiles = dealt.groupBy("label", "size", "low", "high").applyInArrow(compare, "rep long, n long, root long")
    found = written(tiles, "vector-links")
    parts = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "vector-components")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    of_class = (
        classes.join(counts, "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    joined = rows.where("sound").join(of_class, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
