"""Token files: ids of a corpus under one canonical, length-limited Huffman code.

A token file set is a folder with three Parquet tables:

``codebook``  one row: the bits of the longest allowed code and the code length of every id
``blocks``    one row per block of whole documents: part, block, start_in_part, doc_ids, lengths, ends with
              ``payload`` (the code bits, first bit first) and ``checkpoints`` (the bit offset of every
              ``CHECKPOINT_TOKENS``-th id), so any block, and any stretch between two checkpoints, is read alone
``parts``     the number of ids before each part

Documents stand in ascending doc_id order: by part, block, and place in the block. Codes are canonical: the
lengths alone determine them, so the code book stores nothing else. Decoding reads a window of the longest
code's bits, looks the id and its code length up in a table, and goes on; all stretches of a batch go in step.

Every document ends with ``end_id``. A NULL or empty text has that id only. Rows with equal doc_id stay apart
and are ordered by text; NULL doc_ids come first. An empty table gives a file set without blocks. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import (
    part_bounds,
    part_of,
    shared_path,
    shuffle_tasks,
    table,
    text_or_empty,
    written,
)
from tripmill.llm.tokens import encoder_maker

MAX_BITS = 18
BLOCK_TOKENS = 1 << 16
CHECKPOINT_TOKENS = 256
_BATCH_TOKENS = 1 << 20

_BLOCKS = (
    "part int, block int, start_in_part long, n_tokens long, doc_ids array<long>, lengths array<int>, "
    "payload binary, checkpoints array<int>"
)


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Best code length of every symbol with a count, none over ``max_bits``; 0 for symbols without (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols need codes of more than {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.int64)
    merged, levels = np.zeros(0, dtype=np.int64), []
    for _ in range(max_bits):
        pairs = merged[: len(merged) // 2 * 2]
        level = np.concatenate([coins, pairs[0::2] + pairs[1::2]])
        by_weight = np.argsort(level, kind="stable")
        levels.append(by_weight < len(coins))
        merged = level[by_weight]
    take = 2 * len(order) - 2
    for is_coin in reversed(levels):
        coins_taken = int(is_coin[:take].sum())
        lengths[order[:coins_taken]] += 1
        take = 2 * (take - coins_taken)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of every symbol, from lengths alone: shorter codes first, then smaller symbols."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        longest = int(lengths[order].max())
        # As fractions of the code space, each code begins where the one before ends.
        spans = np.uint64(1) << (longest - lengths[order]).astype(np.uint64)
        starts = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spans)[:-1]])
        codes[order] = starts >> (longest - lengths[order]).astype(np.uint64)
    return codes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The code bits of ``ids`` and the bit offset of each id."""
    bits = lengths[ids]
    ends = np.cumsum(bits)
    if not len(ids):
        return b"", ends
    starts = ends - bits
    unit, within = starts >> 5, starts & 31
    # A code of at most 32 bits lies in two 32-bit units; codes in one unit do not overlap, so they add up.
    wide = codes[ids] << (64 - bits - within).astype(np.uint64)
    units = np.zeros(int(unit[-1]) + 2, dtype=np.uint64)
    first = np.flatnonzero(np.diff(unit, prepend=-1))
    units[unit[first]] += np.add.reduceat(wide >> np.uint64(32), first)
    units[unit[first] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
    return units.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], starts


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every window of the longest code's bits: symbol * 64 + code length."""
    longest = max(int(lengths.max(initial=0)), 1)
    entries = np.zeros(1 << longest, dtype=np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    filled = np.repeat(order * 64 + lengths[order], 1 << (longest - lengths[order]))
    entries[: len(filled)] = filled
    return entries, longest


def decode_bits(payload: np.ndarray, offsets: np.ndarray, counts: np.ndarray, entries: np.ndarray, longest: int) -> np.ndarray:
    """The ids of stretches that begin at bit ``offsets`` and hold ``counts`` ids, one stretch after the other."""
    data = np.concatenate([payload, np.zeros(8, np.uint8)]).astype(np.uint32)
    words = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    begins = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, place, left = offsets[order].copy(), begins[order], counts[order]
    active = len(order)
    for step in range(int(left[0]) if active else 0):
        while left[active - 1] <= step:
            active -= 1
        here = at[:active]
        window = (words[here >> 3] >> (32 - longest - (here & 7)).astype(np.uint32)) & ((1 << longest) - 1)
        found = entries[window]
        out[place[:active] + step] = found >> 6
        at[:active] += found & 63
    return out


def _ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), dtype="<u4")


def encoded(docs: DataFrame, path: str, kind: str | None, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids compressed, each row's document by itself; counts of ids come last of each task.

    Such a row has n_tokens -1; its ids are how often the task met each id, from 0 on, as compressed 64-bit integers.
    """
    make = encoder_maker(docs.sparkSession.sparkContext, path, kind)
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pack = make(), zstandard.ZstdCompressor(level=1)
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            plain = [encode(t.as_py()) + end for t in batch.column(1)]
            found = np.bincount(np.frombuffer(b"".join(plain), "<u4"), minlength=len(total))
            found[: len(total)] += total
            total = found
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(p) // 4 for p in plain], pa.int64()),
                    pa.array([pack.compress(p) for p in plain], pa.binary()),
                ],
                names=names,
            )
        counts = [pack.compress(total.astype("<i8").tobytes())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([-1], pa.int64()), pa.array(counts, pa.binary())], names=names
        )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_counts(ids: DataFrame) -> np.ndarray:
    """Count of every id over all rows of ``encoded``. The driver gets one number per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                found = np.frombuffer(zstandard.decompress(packed.as_py()), "<i8").copy()
                if len(found) < len(total):
                    found, total = total, found
                found[: len(total)] += total
                total = found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    of_tasks = ids.where("n_tokens < 0").select("ids").mapInArrow(count, "id long, n long")
    rows = of_tasks.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        counts[r.id] = r.n
    return counts


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    kind: str | None,
    end_id: int,
    max_bits: int = MAX_BITS,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encode ``docs`` (doc_id, text) and write the token files to ``folder``."""
    spark = docs.sparkSession
    bounds = part_bounds(docs, "doc_id", shuffle_tasks(spark))
    ids = written(encoded(docs, tokenizer, kind, end_id), "token-ids")
    lengths = code_lengths(id_counts(ids), max_bits)
    codes = canonical_codes(lengths)
    spark.createDataFrame([(max_bits, lengths.tolist())], "max_bits int, lengths array<int>").coalesce(1).write.parquet(f"{folder}/codebook")
    sent = spark.sparkContext.broadcast((lengths, codes))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number = start = held = 0
        doc_ids, parts = [], []

        def block() -> pa.RecordBatch:
            flat = np.concatenate(parts)
            payload, offsets = encode_bits(flat, *sent.value)
            row = {
                "part": part,
                "block": number,
                "start_in_part": start,
                "n_tokens": len(flat),
                "doc_ids": doc_ids,
                "lengths": [len(p) for p in parts],
                "payload": payload,
                "checkpoints": offsets[::CHECKPOINT_TOKENS].tolist(),
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = _ids(packed.as_py())
                # A document longer than a block is a block of its own.
                if parts and held + len(found) > block_tokens:
                    yield block()
                    number, start = number + 1, start + held
                    doc_ids, parts, held = [], [], 0
                doc_ids.append(doc_id)
                parts.append(found)
                held += len(found)
        if parts:
            yield block()

    parted = ids.where("n_tokens >= 0").withColumn("part", part_of(F.col("doc_id"), bounds)).repartitionById(len(bounds), "part")
    ordered = parted.sortWithinPartitions("doc_id", "ids").select("doc_id", "ids")
    ordered.mapInArrow(blocks, _BLOCKS).write.parquet(f"{folder}/blocks")
    made = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    sizes = sorted((r.part, r.n_tokens) for r in made.collect())  # as many rows as parts
    before = np.cumsum([0, *(n for _, n in sizes)])[:-1].tolist() if sizes else []
    rows = [(p, b) for (p, _), b in zip(sizes, before, strict=True)]
    spark.createDataFrame(rows, "part int, start long").coalesce(1).write.parquet(f"{folder}/parts")


_BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("start_in_part", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("payload", pa.binary()),
        ("checkpoints", pa.list_(pa.int32())),
    ]
)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids as little-endian unsigned 32-bit integers."""
    lengths = np.array(spark.read.parquet(f"{folder}/codebook").first().lengths, dtype=np.int64)
    sent = spark.sparkContext.broadcast(decoding_table(lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, longest = sent.value
        for batch in batches:
            for rows in _groups(batch):
                yield _decoded(rows, entries, longest)

    columns = ["part_start", "start_in_part", "n_tokens", "doc_ids", "lengths", "payload", "checkpoints"]
    parts = spark.read.parquet(f"{folder}/parts").withColumnRenamed("start", "part_start")
    blocks = spark.read.parquet(f"{folder}/blocks").join(parts, "part").select(columns)
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _groups(batch: pa.RecordBatch) -> Iterator[list[dict]]:
    """Blocks taken together until they hold about ``_BATCH_TOKENS`` ids."""
    rows, held = [], 0
    for i in range(batch.num_rows):
        row = batch.slice(i, 1)
        rows.append(row)
        held += row.column("n_tokens")[0].as_py()
        if held >= _BATCH_TOKENS:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def _decoded(rows: list[pa.RecordBatch], entries: np.ndarray, longest: int) -> pa.RecordBatch:
    payloads = [np.frombuffer(r.column("payload")[0].as_py(), np.uint8) for r in rows]
    bases = np.cumsum([0, *(len(p) for p in payloads)])
    offsets, counts = [], []
    for row, base in zip(rows, bases, strict=False):
        marks = row.column("checkpoints").flatten().to_numpy().astype(np.int64)
        total = row.column("n_tokens")[0].as_py()
        offsets.append(marks + base * 8)
        counts.append(np.minimum(CHECKPOINT_TOKENS, total - np.arange(len(marks)) * CHECKPOINT_TOKENS))
    flat = decode_bits(np.concatenate(payloads), np.concatenate(offsets), np.concatenate(counts), entries, longest)
    doc_ids = pa.concat_arrays([r.column("doc_ids").flatten() for r in rows])
    sizes = [r.column("lengths").flatten().to_numpy().astype(np.int64) for r in rows]
    starts = [
        r.column("part_start")[0].as_py() + r.column("start_in_part")[0].as_py() + np.cumsum(s) - s
        for r, s in zip(rows, sizes, strict=True)
    ]
    size = np.concatenate(sizes)
    ends = np.concatenate([[0], np.cumsum(size)]) * 4
    ids = pa.Array.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat.astype("<u4"))]
    )
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(np.concatenate(starts)), pa.array(size), ids.cast(pa.binary())],
        names=["doc_id", "start", "n_tokens", "ids"],
    )


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    folder = shared_path(spark, "token-files")
    path = public_tokenizers.path("word_bpe_49k.json")
    write_token_files(table(spark, sf_dir, "documents"), folder, path, "word_end", end_id=2)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
