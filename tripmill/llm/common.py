"""What the operators share: tables, written intermediate results, ordered parts, components."""

from __future__ import annotations

import ctypes
import json
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bits of the filters before semi-joins, four megabytes.
FILTER_BITS = 1 << 25
#: Bytes of rows that a Python worker gets at a time, unless the session names another number than Spark's default.
BATCH_BYTES = 4 << 20
_DEFAULT_BATCH = "67108864b"
#: Rows of two numbers that are worth a task of their own.
ROWS_A_TASK = 1 << 14


def give_memory_back() -> None:
    """Let a worker process return large arrays and batches to the system as soon as they are freed.

    Workers live on from stage to stage; what their allocators keep would add up to what the next stage takes.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL("libc.so.6").mallopt(-3, 4 << 20)  # blocks of this size are mapped by themselves
    except (OSError, AttributeError):
        pass  # another C library


give_memory_back()


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python workers in batches of few megabytes, so that a worker's memory follows neither rows nor texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == _DEFAULT_BATCH:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``.

    A session on one machine without that setting (a test) gets a folder of its own; on a cluster it is an error,
    as a folder of one machine is none that the others see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[(?!.*cluster)|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that all machines share")
        base = f"file://{tempfile.mkdtemp(prefix='tripmill-llm-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_to = path
    return found


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage now: Spark removes the shuffle files of queries that nothing refers to any more.

    Between heavy steps, as otherwise those of all steps pile up on the executors' disks until the driver's memory fills.
    """
    spark._jvm.java.lang.System.gc()


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def part_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """The smallest ``key`` of each of at most ``parts`` ranges of about as many rows; reads that column only.

    As many numbers as there are shuffle tasks reach the driver.
    """
    ids = df.select(F.col(key).cast("long").alias("k")).where("k IS NOT NULL")
    ranges = ids.repartitionByRange(parts, "k").groupBy(F.spark_partition_id().alias("p"))
    return sorted({row.k for row in ranges.agg(F.min("k").alias("k")).collect()}) or [0]


def part_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range of ``part_bounds`` in which ``key`` lies; NULL lies in the first."""
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def part(keys: pd.Series) -> pd.Series:
        known = keys.fillna(edges[0]).astype("int64").to_numpy()
        return pd.Series(np.maximum(np.searchsorted(edges, known, side="right") - 1, 0).astype("int32"))

    return part(key.cast("long"))


def starts_part(key: Column, bounds: list[int]) -> Column:
    """Whether ``key`` is one of ``bounds``; false for NULL."""
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("boolean")
    def starts(keys: pd.Series) -> pd.Series:
        return keys.notna() & keys.fillna(0).astype("int64").isin(edges)

    return starts(key.cast("long"))


def frequent(counts: DataFrame, most: int, keys: list[str] | None = None) -> DataFrame:
    """The ``most`` rows of ``counts`` (..., n) with the largest n; of the rows of the last n, those of smallest hash.

    Hashes are those of ``keys``, or of all columns but n.

    The driver gets the number of rows for each n and for each of 65,536 ranges of hashes of the last n, and the
    hashes in one of these ranges. Rows of equal hash at the edge stay out together.
    """
    keys = keys or [c for c in counts.columns if c != "n"]
    sizes = counts.groupBy("n").agg(F.count("*").alias("rows")).collect()
    left = most
    for row in sorted(sizes, key=lambda r: -r.n):
        if row.rows > left:
            break
        left -= row.rows
    else:
        return counts
    digest = F.xxhash64(*keys)
    part = F.shiftrightunsigned(digest, 48)
    tied = counts.where(F.col("n") == row.n).select(digest.alias("digest"), part.alias("part"))
    for edge in sorted(tied.groupBy("part").agg(F.count("*").alias("rows")).collect(), key=lambda r: r.part):
        if edge.rows > left:
            break
        left -= edge.rows
    digests = sorted(r.digest for r in tied.where(F.col("part") == edge.part).select("digest").collect())
    inside = (part < edge.part) | ((part == edge.part) & (digest < digests[left]))
    return counts.where((F.col("n") > row.n) | ((F.col("n") == row.n) & inside))


def to_file(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays of 64-bit numbers one after the other, behind a line with their names, kinds and lengths."""
    head = json.dumps({name: (a.dtype.kind, len(a)) for name, a in arrays.items()}).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    return head + b"".join(np.ascontiguousarray(a, dtype=f"<{a.dtype.kind}8").tobytes() for a in arrays.values())


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file made by ``to_file``, memory-mapped."""
    with open(path, "rb") as file:
        line = file.readline()
    at, arrays = len(line), {}
    for name, (kind, length) in json.loads(line).items():
        dtype = f"<{kind}8"
        arrays[name] = np.memmap(path, dtype, "r", at, (length,)) if length else np.zeros(0, dtype)
        at += 8 * length
    return arrays


def shared_file(spark: SparkSession, data: bytes, name: str) -> str:
    """``data`` as a file in the shared folder that Spark hands to every executor; the name to find it by."""
    path = f"{shared_path(spark, name)}.bin"
    context = spark.sparkContext
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    try:
        for start in range(0, len(data), 1 << 22):
            stream.write(bytearray(data[start : start + (1 << 22)]))
    finally:
        stream.close()
    context.addFile(path)
    return path.rsplit("/", 1)[1]


def bit_array(places: DataFrame, bits: int) -> np.ndarray:
    """Words of 64 bits in which the bits at ``places`` (one column of longs below ``bits``) are set."""
    words = places.toDF("p").groupBy(F.shiftright("p", 6).alias("word"))
    rows = words.agg(F.expr("bit_or(shiftleft(1L, CAST(p & 63 AS INT))) AS v")).toArrow()
    array = np.zeros(bits >> 6, dtype=np.int64)
    array[rows.column("word").to_numpy()] = rows.column("v").to_numpy()
    return array


def possibly_in(key: Column, ids: DataFrame, bits: int = FILTER_BITS) -> Column:
    """False only where ``key`` is surely not in ``ids`` (one column of longs): a semi-join's filter before its shuffle.

    A bit array of fixed size, whatever the number of ids: as it fills, it lets more rows through, all of
    which the join then decides.
    """
    spark = ids.sparkSession
    places = ids.select(F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(bits)))
    sent = spark.sparkContext.broadcast(bit_array(places, bits))

    @F.pandas_udf("boolean")
    def hit(places: pd.Series) -> pd.Series:
        p = places.to_numpy()
        return pd.Series((sent.value[p >> 6] >> (p & 63)) & 1 == 1)

    return hit(F.pmod(F.xxhash64(key), F.lit(bits)))


def tied(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest one that ``pairs`` tie it to."""
    root = np.arange(n)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        for side in (0, 1):
            np.minimum.at(root, root[pairs[:, side]], low)
            np.minimum.at(root, pairs[:, side], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, few enough at a time for ``most`` bytes or elements of a column, but one at least."""
    values = batch.column(column)
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    ends = np.cumsum(pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most about ``rows`` rows, made by as many tasks as these are worth, two at least."""
    tasks = max(2, -(-rows // ROWS_A_TASK))
    return df.coalesce(tasks) if tasks < shuffle_tasks(df.sparkSession) else df


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node that links reach.

    Alternating large-star and small-star steps, each written to the shared folder, until all that is left are stars
    around their smallest node. Stars of any size are merged by aggregates, whose results are written before they are joined: both sides of a
    join are then plain shuffles, of which adaptive execution splits those that one hub fills over several tasks.
    No step has more edges than there are links, so small ones are written by few tasks.
    """
    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    now = written(now.distinct(), name)
    rows = now.count()
    while True:
        # Large star: every larger neighbour of a node is tied to the node's smallest neighbour.
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        lows = both.groupBy("u").agg(
            F.least("u", F.min("v")).alias("m"),
            F.count_if(F.col("v") < F.col("u")).alias("smaller"),
            F.count_if(F.col("v") > F.col("u")).alias("larger"),
        )
        lows = written(few_tasks(lows, rows), f"{name}-least")
        if not lows.where("smaller > 1 OR (smaller > 0 AND larger > 0)").count():
            forget(lows)
            break
        large = both.where("v > u").join(lows.select("u", "m"), "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = written(few_tasks(large.where("a < b").distinct(), rows), f"{name}-large")
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        least = written(few_tasks(large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), rows), f"{name}-least")
        down = large.withColumnRenamed("b", "u").join(least, "u").select("m", F.col("a").alias("b"))
        small = down.union(least.select("m", F.col("u").alias("b"))).where("m < b").distinct()
        after = written(few_tasks(small.toDF("a", "b"), rows), name)
        forget(now, lows, large, least)
        now = after
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
