"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Words are runs of anything but space and the controls 9 to 13, with A-Z in lower case; a document's set holds its
distinct shingles of ``size`` words (a shorter text is one shingle). Documents with a Jaccard similarity of
``percent`` per cent or more are linked; components of links are groups, and the smallest doc_id of a group is kept.

1. Every text gets ``BANDS * ROWS`` minima. A band's minima make one key; of each minimum the low four bits
   go into a packed signature. Texts with the same words are one class, compared once.
2. Documents that share a key are candidates. Each is paired with the smallest member of each of its buckets,
   and equal nibbles of two signatures, found by bit counts and corrected for chance collisions, estimate
   the similarity. Pairs that cannot reach the threshold (five standard deviations) are dropped.
3. The best such pair of each document is confirmed on the texts' own sets; this ties most of every group
   together. All other pairs of a bucket are then needed only where the bucket still holds several
   components: there its members are compared in blocks by their signatures.
4. Members with such candidates are grouped, and a group's texts are compared in tiles of two blocks, by hashes
   of their shingles and, before a link is made, by the shingles themselves.

Buckets and groups of any size are cut into blocks; copies and pairs within a component are not expanded. A pair at the
threshold shares no band with probability (1 - 0.8 ** 5) ** 32, three in a million, and more similar ones less.

NULL or empty text and text without words: the empty set, linked with nothing. A row with NULL doc_id has NULL
as component, links with nothing and is kept. Rows that repeat a doc_id are one document with one component; if
their texts differ, any one of these is compared. An empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import components, possibly_in, shuffle_tasks, table, text_or_empty, tied, written
from tripmill.llm.tokens import Filled

BANDS, ROWS = 32, 5
MINIMA = BANDS * ROWS
BITS = 4
BLOCK = 512
#: Members with their texts in a block.
TEXT_BLOCK = 128
_RANDOM = np.random.Generator(np.random.PCG64(7))
_TIMES = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_MIX = _RANDOM.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_COLUMNS = 2048


def words_of(text: str) -> list[bytes]:
    # Bytes know ASCII only: A-Z become lower case, and the six white-space characters part words.
    return text.encode("utf-8").lower().split()


def shingles(text: str, size: int) -> set[tuple[bytes, ...]]:
    """The exact set of a text."""
    words = words_of(text)
    if len(words) <= size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of the shingles of a text, from the hashes of its words."""
    if len(words) <= size:
        size = len(words)
    mixed = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        mixed = (mixed ^ words[i : len(words) - size + 1 + i]) * _STEP
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each of ``MINIMA`` hash functions over a set."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), _COLUMNS):
        values = np.multiply.outer(_TIMES, hashes[start : start + _COLUMNS])
        values += _PLUS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least >> np.uint64(32)


def packed(least: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each minimum, two to a byte."""
    low = (least & np.uint64(15)).astype(np.uint8)
    return (low[0::2] | low[1::2] << 4).tobytes()


def band_keys(least: np.ndarray) -> np.ndarray:
    mixed = ((least.reshape(BANDS, ROWS) + np.uint64(1)) * _MIX).sum(axis=1, dtype=np.uint64) ^ _BAND
    mixed = (mixed ^ mixed >> np.uint64(31)) * _STEP
    return (mixed ^ mixed >> np.uint64(29)).view(np.int64)


def equal_minima(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many packed nibbles agree, for rows of 64-bit words."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return MINIMA - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=-1, dtype=np.int64)


def least_equal(percent: int) -> int:
    """Fewest equal nibbles with which a pair at ``percent`` is found, five standard deviations below the mean."""
    chance = 1 / (1 << BITS)
    p = chance + (1 - chance) * percent / 100
    return int(MINIMA * p - 5 * np.sqrt(MINIMA * p * (1 - p)))


def estimate(equal: np.ndarray) -> np.ndarray:
    """Similarity corrected for nibbles that agree by chance."""
    chance = 1 / (1 << BITS)
    return np.clip((equal / MINIMA - chance) / (1 - chance), 0.0, 1.0)


def _signatures(column: pa.Array | pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(v) for v in column), dtype="<u8").reshape(-1, MINIMA * BITS // 64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, digest, signature, bands); digest, signature and bands are NULL for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Filled(xxhash.xxh3_64_intdigest, 300_000).__getitem__
        for batch in batches:
            sizes, digests, signatures, bands = [], [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                if not words:
                    sizes.append(0)
                    for column in (digests, signatures, bands):
                        column.append(None)
                    continue
                found = shingle_hashes(np.fromiter(map(hashed, words), np.uint64, len(words)), size)
                least = minima(found)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                signatures.append(packed(least))
                bands.append(band_keys(least))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "signature", "bands"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary, bands array<long>")


def equal_column(a: str, b: str) -> Column:
    """Number of equal minima of two columns of signatures."""

    @F.pandas_udf("int")
    def equal(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series(equal_minima(_signatures(one), _signatures(other)).astype("int32"))

    return equal(a, b)


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets reach ``percent``."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    texts = docs.where(possibly_in(F.col("doc_id"), ends)).select("doc_id", "text")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, known = [], None, set()
            for a, one, other in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, known = a, shingles(one.as_py(), size)
                theirs = shingles(other.as_py(), size)
                same = len(known & theirs)
                keep.append(100 * same >= percent * (len(known) + len(theirs) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def candidates_in_buckets(rows: DataFrame, fewest: int) -> DataFrame:
    """Edges (a, b) that tie together members of a tile with a candidate: another label, enough equal minima.

    ``rows`` are sorted by tile. A tile has members of at most two blocks. Tiles are cut out of the stream of rows one by one.
    """

    def tile(side: np.ndarray, ids: np.ndarray, labels: np.ndarray, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = np.flatnonzero(side <= 0)
        right = np.flatnonzero(side >= 0)
        apart = labels[left][:, None] != labels[right][None, :]
        near = equal_minima(signatures[left][:, None, :], signatures[right][None, :, :]) >= fewest
        i, j = np.nonzero(apart & near)
        # As many edges as tie the candidates together, not all pairs.
        roots = tied(len(ids), np.stack([left[i], right[j]], axis=1))
        some = np.flatnonzero(roots != np.arange(len(ids)))
        return ids[roots[some]], ids[some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
            side, ids, labels = (rows.column(c).to_numpy() for c in ("side", "doc_id", "label"))
            signatures = _signatures(rows.column("signature").to_pylist())
            found, start = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
            for end in ends.tolist():
                if end - start > 1 and labels[start:end].min() != labels[start:end].max():
                    found.append(tile(side[start:end], ids[start:end], labels[start:end], signatures[start:end]))
                start = end
            a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]) if held is not None else now
            key = np.stack([now.column(c).to_numpy() for c in ("key", "i", "j")])
            ends = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(ends):  # the last tile may go on in the next batch
                yield pairs(now.slice(0, int(ends[-1])), ends)
                now = now.slice(int(ends[-1]))
            held = now.combine_chunks()
        if held is not None and held.num_rows:
            yield pairs(held, np.array([held.num_rows]))

    return rows.mapInArrow(run, "a long, b long").distinct()


def linked_in_groups(members: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of a group with different labels, as many as tie linked ones together.

    ``members``: (group, doc_id, label, signature, text). A group is cut into blocks; a tile has the members
    of two of them, with one row for each, however many pairs they make. Pairs already tied are not compared.
    """
    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / TEXT_BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "group")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        F.signum(F.col("block") - F.col("other")).cast("int").alias("side"),
        "doc_id",
        "label",
        "signature",
        "text",
    )
    fewest = least_equal(percent)

    def reaches(same: int, one: int, other: int) -> bool:
        return 100 * same >= percent * (one + other - same)

    def compare(rows: pa.Table) -> pa.Table:
        side, ids, labels = (rows.column(c).to_numpy() for c in ("side", "doc_id", "label"))
        signatures = _signatures(rows.column("signature").to_pylist())
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        near = equal_minima(signatures[left][:, None, :], signatures[right][None, :, :])
        i, j = np.nonzero((labels[left][:, None] != labels[right][None, :]) & (near >= fewest))
        likely = np.argsort(-near[i, j], kind="stable")
        i, j = left[i][likely], right[j][likely]
        texts, hashed = rows.column("text"), {}
        root = {label: label for label in labels.tolist()}

        def find(label: int) -> int:
            while root[label] != label:
                root[label] = label = root[root[label]]
            return label

        def hashes(n: int) -> np.ndarray:
            if n not in hashed:
                words = words_of(texts[n].as_py())
                numbers = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                hashed[n] = shingle_hashes(numbers, size)
            return hashed[n]

        links = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            one, other = find(int(labels[a])), find(int(labels[b]))
            if one == other:
                continue
            same = len(np.intersect1d(hashes(a), hashes(b), assume_unique=True))
            if reaches(same, len(hashes(a)), len(hashes(b))):
                mine, theirs = shingles(texts[a].as_py(), size), shingles(texts[b].as_py(), size)
                if reaches(len(mine & theirs), len(mine), len(theirs)):
                    root[max(one, other)] = min(one, other)
                    links.append((int(ids[a]), int(ids[b])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return tiles.groupBy("group", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    known = docs.where("doc_id IS NOT NULL")
    sketched = written(sketches(docs, size), "sketches")
    full = sketched.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = written(full.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = full.join(classes, (full.doc_id == classes.rep) & (full.digest == classes.digest), "left_semi")
    reps = reps.groupBy("doc_id").agg(F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    reps = written(reps, "representatives")
    signatures = reps.select("doc_id", "signature")

    keys = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("center"), F.count("*").alias("n")).where("n > 1")
    members = written(keys.join(shared, "key"), "bucket-members")
    stars = members.where("doc_id <> center").select(F.col("center").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = stars.join(signatures.toDF("a", "signature_a"), "a").join(signatures.toDF("b", "signature_b"), "b")
    fewest = least_equal(percent)
    stars = stars.select("a", "b", equal_column("signature_a", "signature_b").alias("equal")).where(F.col("equal") >= fewest)
    stars = written(stars, "stars")

    best = written(stars.groupBy("b").agg(F.max_by("a", F.struct("equal", -F.col("a"))).alias("a")).select("a", "b"), "best-stars")
    links = written(confirmed(best, known, size, percent), "star-links")
    labels = components(links, "star-components").select(F.col("node").alias("doc_id"), F.col("component").alias("label"))

    def labelled(rows: DataFrame, of: str, name: str) -> DataFrame:
        named = rows.join(labels.select(F.col("doc_id").alias(of), F.col("label").alias(name)), of, "left")
        return named.withColumn(name, F.coalesce(name, of))

    # Buckets of two hold no pair but their star's.
    large = written(labelled(members.where("n > 2").select("key", "doc_id"), "doc_id", "label"), "large-buckets")
    mixed = large.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    mixed = mixed.where("low <> high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    tiles = large.join(mixed, "key").join(signatures, "doc_id").withColumn("block", block)
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        F.signum(F.col("block") - F.col("other")).cast("int").alias("side"),
        "doc_id",
        "label",
        "signature",
    )
    tiles = tiles.repartition(shuffle_tasks(docs.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")
    rest = labelled(labelled(stars.select("a", "b"), "a", "label_a"), "b", "label_b")
    rest = rest.join(best, ["a", "b"], "left_anti").where("label_a <> label_b").select("a", "b")
    apart = components(rest.union(candidates_in_buckets(tiles, fewest)), "candidates").toDF("doc_id", "group")
    apart = written(labelled(apart, "doc_id", "label").join(signatures, "doc_id"), "candidate-members")
    texts = known.where(possibly_in(F.col("doc_id"), apart.select("doc_id"))).dropDuplicates(["doc_id"])
    links = written(links.union(linked_in_groups(apart.join(texts, "doc_id"), size, percent)), "links")

    groups = components(links, "components").toDF("rep", "component")
    of_class = classes.join(groups, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    result = sketched.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)
