"""Document fingerprints from content-defined chunks.

A gear hash rolls over a text's UTF-8 bytes and ends a chunk where bits of it are zero: more bits before the
aimed size, fewer after it, so sizes gather around the aim. Where a chunk ends depends on the bytes just before
alone, so an insertion or a cut changes chunks near it and no others. The fingerprint lists each different
chunk's digest with the bytes that it covers. The likeness of one fingerprint to another is the share of its
bytes whose chunks the other has too: containment, weighted by length.

NULL text is empty; the fingerprint of the empty text is the empty string, alike to itself (1) and to nothing
else (0). Rows are ordered by doc_id, ties by text, NULL first; the row after the last is the first. Repeated rows
stay. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import part_bounds, part_of, shuffle_tasks, starts_part, table, text_or_empty

SMALLEST, AIM, LARGEST = 16, 48, 192
#: Bits of the hash that must be zero before and after the aimed size.
BITS_BEFORE, BITS_AFTER = 7, 4
_GEAR = np.random.Generator(np.random.PCG64(20240601)).integers(0, 1 << 32, 256, dtype=np.uint32)
_DIGEST_BYTES = 6


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end."""
    if not data:
        return []
    rolled = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    # The hash of the last 32 bytes: each byte's gear moved left by one place per byte since. Doubling.
    reach = 1
    while reach < 32:
        moved = rolled.copy()
        moved[reach:] += rolled[:-reach] << np.uint32(reach)
        rolled, reach = moved, reach * 2
    easy = np.flatnonzero(rolled >> np.uint32(32 - BITS_AFTER) == 0)
    hard = easy[rolled[easy] >> np.uint32(32 - BITS_BEFORE) == 0].tolist()
    easy, total = easy.tolist(), len(data)
    ends, start, e, h = [], 0, 0, 0
    hard.append(total)
    easy.append(total)
    while start < total:
        while hard[h] < start + SMALLEST - 1 and h < len(hard) - 1:
            h += 1
        end = hard[h] + 1
        if end > start + AIM:
            while easy[e] < start + AIM and e < len(easy) - 1:
                e += 1
            end = min(easy[e] + 1, start + LARGEST)
        start = min(end, total)
        ends.append(start)
    return ends


def chunks(data: bytes) -> dict[str, int]:
    """Digest of each different chunk and the bytes it covers, in order of first appearance."""
    covered: dict[str, int] = {}
    start = 0
    for end in chunk_ends(data):
        digest = hashlib.blake2b(data[start:end], digest_size=_DIGEST_BYTES).hexdigest()
        covered[digest] = covered.get(digest, 0) + end - start
        start = end
    return covered


def fingerprint(covered: dict[str, int]) -> str:
    return ",".join([f"{digest}:{size}" for digest, size in covered.items()])


def likeness(one: dict[str, int], other: dict[str, int]) -> float:
    """Share of the bytes of ``one`` whose chunks ``other`` has."""
    total = sum(one.values())
    if not total:
        return 0.0 if other else 1.0
    return sum([size for digest, size in one.items() if digest in other]) / total


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_text", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """Documents dealt to tasks by ranges of doc_id and ordered; each task ends with the first row of the next.

    (part, doc_id, text, tail): ``tail`` marks that additional row. One shuffle carries the texts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    bounds = part_bounds(rows, "doc_id", shuffle_tasks(spark))
    n = len(bounds)
    parted = rows.withColumn("part", part_of(F.col("doc_id"), bounds))
    # The rows that may come first in a part: those with its smallest key. NULL keys come first of all.
    nulls_first = not parted.where("doc_id IS NULL").isEmpty()
    first = starts_part(F.col("doc_id"), bounds[1:] if nulls_first else bounds) | F.col("doc_id").isNull()
    places = F.when(first, F.array(F.col("part"), F.pmod(F.col("part") - 1, F.lit(n)))).otherwise(F.array("part"))
    dealt = parted.select("doc_id", "text", F.posexplode(places).alias("tail", "part"))
    dealt = dealt.repartitionById(n, "part").sortWithinPartitions("part", "tail", "doc_id", "text")
    return dealt.select("part", "doc_id", "text", "tail")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness to it and to the next document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = part = None  # the row whose successor has not come yet, with its chunks
        tailed = False
        for batch in batches:
            out: list[dict] = []
            for number, doc_id, text, tail in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True
            ):
                if number != part:
                    waiting, part, tailed = None, number, False
                if tailed:
                    continue  # rows that share the first key of the next part: only the first follows
                text = text.as_py()
                mine = chunks(text.encode("utf-8"))
                if waiting:
                    out.append(_compared(*waiting, text, mine))
                waiting, tailed = (doc_id, text, mine), bool(tail)
            yield pa.RecordBatch.from_pylist(out, schema=_RESULT)

    columns = ", ".join(
        f"{f.name} {'long' if f.type == pa.int64() else 'double' if f.type == pa.float64() else 'string'}" for f in _RESULT
    )
    return in_order_with_next(docs).mapInArrow(run, columns)


def _compared(doc_id: int | None, text: str, mine: dict, following: str, theirs: dict) -> dict:
    changed = edited(text, following)
    new = chunks(changed.encode("utf-8"))
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_text": changed,
        "fingerprint": fingerprint(mine),
        "edited_fingerprint": fingerprint(new),
        "near_edited": likeness(mine, new),
        "near_next": likeness(mine, theirs),
    }


def op4_content_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    compared = compare_with_next(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
