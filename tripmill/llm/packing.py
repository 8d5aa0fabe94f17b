"""Best-fit packing of documents into sequences of bounded length by minimum bin slack.

A document is its ids and an end id. Only documents longer than a sequence are cut, into pieces of the full
length with the shorter rest in front. Pieces of equal length are alike for packing, so the histogram of
lengths (at most ``capacity`` numbers) says all there is to know: bin by bin, the longest piece left is
seated, and a subset-sum dynamic program on bitsets finds the combination of further lengths that leaves the
least slack. That combination is removed as often as the counts allow. The plan made this way assigns bins to
ranks within each length, and every piece looks its rank up.

The rank of a piece is its number among those of its length in its task plus the number in tasks before.
Neither a hot length nor a hot source meets in one task.

NULL or empty text: the end id only. Ties and repeated rows are pieces of their own. NULL doc_ids are kept.
An empty table gives an empty result. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.llm.common import table, text_or_empty, written
from tripmill.llm.tokens import encoder_maker

CAPACITY = 1024
_PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, rank long"


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The longest length left and the further lengths that fill a bin best with it: length to times."""
    seed = max(counts)
    room = capacity - seed
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        times = min(counts[length] - (length == seed), room // length)
        if times <= 0:
            continue
        steps.append((length, times, reach))
        left, block = times, 1
        while left:  # as many as 1, 2, 4, ... at a time, together any number up to ``times``
            some = min(block, left)
            reach = (reach | reach << (some * length)) & mask
            left, block = left - some, block * 2
        if reach >> room & 1:
            break
    found = Counter({seed: 1})
    sum_left = reach.bit_length() - 1
    for length, times, before in reversed(steps):
        used = next(k for k in range(times + 1) if sum_left >= k * length and before >> (sum_left - k * length) & 1)
        if used:
            found[length] += used
            sum_left -= used * length
    return dict(found)


def bin_plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and the number of bins filled with each; all pieces are used."""
    left = {length: n for length, n in counts.items() if n}
    plan = []
    while left:
        combination = fullest(left, capacity)
        bins = min(left[length] // times for length, times in combination.items())
        plan.append((combination, bins))
        for length, times in combination.items():
            left[length] -= bins * times
            if not left[length]:
                del left[length]
    return plan


def _seats(plan: list[tuple[dict[int, int], int]], capacity: int) -> np.ndarray:
    """Rows (length << 48 | first rank, first bin, times in a bin, offset in a bin), sorted, for ranks of a length."""
    given: Counter = Counter()
    rows, first_bin = [], 0
    for combination, bins in plan:
        offset = 0
        for length, times in sorted(combination.items(), reverse=True):
            rows.append((length << 48 | given[length], first_bin, times, offset))
            given[length] += bins * times
            offset += length * times
        first_bin += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, tokenizer: str, kind: str | None, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; ids as little-endian unsigned 32-bit integers."""
    make = encoder_maker(docs.sparkSession.sparkContext, tokenizer, kind)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = make(), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                start, stop, number = 0, total % capacity or capacity, 0
                while start < total:
                    length = stop - start
                    for column, value in zip(
                        rows, (doc_id, number, start, length, ids[start * 4 : stop * 4], seen[length]), strict=True
                    ):
                        column.append(value)
                    seen[length] += 1
                    start, stop, number = stop, stop + capacity, number + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(values, kind) for values, kind in zip(rows, kinds, strict=False)]
            arrays += [pa.array([part] * len(rows[0]), pa.int32()), pa.array(rows[5], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "piece", "start", "length", "ids", "part", "rank"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, _PIECES)


def pack(docs: DataFrame, tokenizer: str, kind: str | None, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of every piece."""
    cut = written(pieces(docs, tokenizer, kind, end_id, capacity), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    bases = written(by_part.withColumn("base", F.coalesce(before, F.lit(0))), "piece-bases")
    totals = bases.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    seats = _seats(bin_plan({r.length: r.n for r in totals}, capacity), capacity)
    sent = docs.sparkSession.sparkContext.broadcast(seats)

    @F.pandas_udf("sequence_id long, offset long")
    def seat(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows, ranks, lengths = sent.value, rank.to_numpy(), length.to_numpy()
        row = rows[np.searchsorted(rows[:, 0], lengths << 48 | ranks, side="right") - 1]
        local = ranks - (row[:, 0] & ((1 << 48) - 1))
        return pd.DataFrame(
            {"sequence_id": row[:, 1] + local // row[:, 2], "offset": row[:, 3] + local % row[:, 2] * lengths}
        )

    joined = cut.join(bases.select("part", "length", "base"), ["part", "length"])
    placed = joined.withColumn("seat", seat("length", F.col("rank") + F.col("base")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "seat.sequence_id", "seat.offset")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = pack(table(spark, sf_dir, "documents"), path, "space_first", end_id=2)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
