"""Removal of passages that repeat across documents: content-defined chunks, grown over what stands around them.

A passage may begin and end anywhere in a text, within lines too, so the lines that are hashed are as short as can be:
a word with the white space behind it. A rolling hash over ``CHUNK_LINES`` line hashes is taken at every line, and
of every ``REACH`` of them in a row the least chooses a boundary. Which one that is depends on these lines alone: any two texts
that share ``PASSAGE_LINES`` lines in a row have a boundary in common there, wherever the passage stands. The
lines that a chosen hash covers are a chunk.

Of the places of a chunk the first (smallest doc_id, then place) is the one that the others are held against: its bytes,
and those around it up to the next chunks, go to the other places and are compared there. A chunk with equal
bytes grows line by line as far as both texts agree. A run of such lines that has ``PASSAGE_LINES`` lines or more goes, as
does a whole text that equals another whole text of ``CHUNK_LINES`` lines or more; shorter repeats, as
of a single license line, stay. Every line that goes is part of a stretch of at least ``CHUNK_LINES`` lines that
stands at an earlier place byte for byte. What stays of a text keeps its bytes and order.

NULL text stays NULL and has no chunks. Rows with NULL doc_id stay as they are and take no part. Rows that repeat
a doc_id are one document: a chunk at the same place of each is one place. Repeats within a document go as
well. Texts of any length are taken whole. An empty table gives an empty result. All columns of the input are kept,
whatever their names; removed_chunks (runs that went) and removed_chars are added, replacing columns with these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import possibly_in, shuffle_tasks, slices, table, written

CHUNK_LINES, REACH = 16, 32
#: Lines that two texts must share in a row to have a chunk in common, and that a run must have to go.
PASSAGE_LINES = CHUNK_LINES + REACH
#: Places that one copy of a first place's bytes answers for.
_SHARE = 512
_SLICE = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def chunk_places(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes): the lines at which chunks begin, and the rolling hash of each chunk."""
    none = np.zeros(0, dtype=np.int64)
    if len(lines) < CHUNK_LINES:
        return none, none
    rolled = hash_array(np.array(lines, dtype=object), categorize=False)
    power, covered = _BASE, 1
    with np.errstate(over="ignore"):
        while covered < CHUNK_LINES:  # hashes of two, four, ... lines
            rolled = rolled[:-covered] * power + rolled[covered:]
            power, covered = power * power, covered * 2
        rolled ^= rolled >> np.uint64(31)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        rolled ^= rolled >> np.uint64(29)
    least, where = rolled, np.arange(len(rolled))
    covered = 1
    while covered < REACH and len(least) > covered:
        right = least[covered:] <= least[:-covered]
        least = np.where(right, least[covered:], least[:-covered])
        where = np.where(right, where[covered:], where[:-covered])
        covered *= 2
    if covered < REACH:  # a text that is shorter than the reach has one chunk
        where = np.array([int(rolled.argmin())])
    chosen = np.unique(where)
    if len(chosen) > 1 and (rolled[chosen[1:]] == rolled[chosen[:-1]]).any():
        # In a text that goes round in circles, equal chunks are chosen once within their length.
        kept = [int(chosen[0])]
        for i in chosen[1:].tolist():
            if rolled[i] != rolled[kept[-1]] or i - kept[-1] >= CHUNK_LINES:
                kept.append(i)
        chosen = np.array(kept)
    return chosen, rolled[chosen].view(np.int64)


def line_ranges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines of a text begin, and where their words end."""
    raw = np.frombuffer(data, dtype=np.uint8)
    word = (raw != 32) & ((raw < 9) | (raw > 13))
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    return edges[::2], edges[1::2]


class Context(NamedTuple):
    """Bytes around a chunk's first place: its begin within them, and whether they are the whole text."""

    begin: int
    data: bytes
    whole: bool


def context(data: bytes, starts: np.ndarray, place: int, before: int, behind: int) -> Context:
    """The text from ``before`` lines ahead of ``place`` to ``behind`` lines from it on."""
    low, high = max(place - before, 0), min(place + behind, len(starts))
    end = int(starts[high]) if high < len(starts) else len(data)
    begin = int(starts[low])
    return Context(int(starts[place]) - begin, data[begin:end], low == 0 and high == len(starts))


def _agree(a: bytes, b: bytes) -> int:
    """Number of bytes in which the beginnings of ``a`` and ``b`` agree."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def _apart(byte: bytes) -> bool:
    return not byte or byte.isspace()


def grown(data: bytes, starts: np.ndarray, ends: np.ndarray, place: int, other: Context) -> tuple[int, int]:
    """The lines [from, to) around ``place`` whose bytes agree with the other place's; none if its chunk does not."""
    at = int(starts[place])
    theirs = other.data[other.begin :]
    same = _agree(data[at : at + len(theirs)], theirs)
    to = place + int(np.searchsorted(ends[place:] - at, same, side="right"))
    # A word that ends where the bytes do must be at its end in the other text as well.
    if to > place and ends[to - 1] - at == same and not _apart(theirs[same : same + 1]):
        to -= 1
    if to - place < CHUNK_LINES:
        return place, place
    if not other.begin:
        return place, to
    mine, theirs = data[max(at - other.begin, 0) : at][::-1], other.data[: other.begin][::-1]
    same = _agree(mine, theirs)
    low = int(np.searchsorted(starts, at - same, side="left"))
    if low < place and at - int(starts[low]) == same and not _apart(theirs[same : same + 1]):
        low += 1
    return low, to


def repeated_runs(data: bytes, places: list[tuple[int, Context]]) -> list[tuple[int, int]]:
    """Ranges of bytes that go: runs of lines that agree with earlier places, begin to end, in order."""
    starts, ends = line_ranges(data)
    found = []
    for place, other in places:
        if place >= len(starts):
            continue  # of another row with this doc_id
        low, to = grown(data, starts, ends, place, other)
        if other.whole and to - low == len(starts) and other.data.strip() == data.strip():
            return [(int(starts[0]), len(data))]
        if to > low:
            found.append((low, to))
    runs: list[list[int]] = []
    for low, to in sorted(found):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], to)
        else:
            runs.append([low, to])
    return [
        (int(starts[a]), int(starts[b]) if b < len(starts) else len(data)) for a, b in runs if b - a >= PASSAGE_LINES
    ]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def chunk_table(docs: DataFrame) -> DataFrame:
    """(doc_id, place, chunk) of every chunk of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
            found = [chunk_places(text.as_py().encode("utf-8").split()) for text in batch.column(1)]
            counts = [len(places) for places, _ in found]
            arrays = [
                pa.array(np.repeat(batch.column(0).to_numpy(), counts)),
                pa.array(np.concatenate([p for p, _ in found]).astype(np.int32)),
                pa.array(np.concatenate([h for _, h in found])),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "place", "chunk"])

    return docs.mapInArrow(run, "doc_id long, place int, chunk long")


def later_places(chunks: DataFrame) -> DataFrame:
    """(doc_id, place, chunk, first_doc, first_place, n): places of repeated chunks but the first; n places in all.

    Chunks that more places share than a task should have are joined apart; there are fewer of these than tasks.
    """
    tasks = shuffle_tasks(chunks.sparkSession)
    shared = chunks.groupBy("chunk").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n"))
    shared = shared.where("n > 1").select(
        "chunk", F.col("first.doc_id").alias("first_doc"), F.col("first.place").alias("first_place"), "n"
    )
    shared = written(shared, "shared-chunks")
    crowded = shared.where(F.col("n") > chunks.count() / tasks)
    hot = [row.chunk for row in crowded.select("chunk").collect()]
    is_hot = F.col("chunk").isin(hot) if hot else F.lit(False)
    parts = [chunks.where(~is_hot).join(shared.where(~is_hot), "chunk")]
    if hot:
        parts.append(chunks.where(is_hot).join(F.broadcast(crowded), "chunk"))
    joined = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return joined.where("doc_id <> first_doc OR place <> first_place")


def questions(places: DataFrame) -> DataFrame:
    """(doc_id, place, chunk, first_doc, first_place, n, before, behind): the lines that each place asks for.

    Up to the next place that repeats the same document at the same distance its chunk asks for the lines between;
    at the ends of such a row for all lines that a common passage can have beyond it.
    """
    row = F.struct("place", "chunk", "first_doc", "first_place", "n")
    by_doc = places.groupBy("doc_id").agg(F.sort_array(F.collect_set(row)).alias("rows"))

    def follows(a, b):  # noqa: ANN001, ANN202
        gap = b.place - a.place
        return (a.first_doc == b.first_doc) & (b.first_place - a.first_place == gap) & (gap <= REACH)

    def asked(r, i):  # noqa: ANN001, ANN202
        left, right = F.get("rows", i - 1), F.get("rows", i + 1)
        goes_on = F.coalesce(follows(r, right), F.lit(False))
        behind = F.when(goes_on, F.greatest(right.place - r.place, F.lit(CHUNK_LINES))).otherwise(PASSAGE_LINES)
        before = F.when(F.coalesce(follows(left, r), F.lit(False)), 0).otherwise(REACH)
        return F.struct(
            r.place.alias("place"),
            r.chunk.alias("chunk"),
            r.first_doc.alias("first_doc"),
            r.first_place.alias("first_place"),
            r.n.alias("n"),
            before.alias("before"),
            behind.alias("behind"),
        )

    return by_doc.select("doc_id", F.inline(F.transform("rows", asked)))


def answers(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, found): for every document that asks, the places with the bytes of their chunks' first places."""
    key = ["first_doc", "first_place", "chunk", "before", "behind"]
    copies = F.ceil(F.col("n") / _SHARE).cast("int")
    fields = ("first_place", "chunk", "before", "behind", "copies")
    wanted = asked.groupBy(key).agg(F.max(copies).alias("copies"))
    of_doc = wanted.groupBy("first_doc").agg(
        F.collect_list(F.struct(*fields)).alias("wanted")
    )
    of_doc = written(of_doc.withColumnRenamed("first_doc", "__first"), "chunk-questions")
    texts = docs.where(possibly_in(F.col("doc_id"), of_doc.select("__first")))
    texts = texts.join(of_doc, F.col("doc_id") == F.col("__first")).select("doc_id", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
            lists = batch.column(2)
            flat, edges = lists.flatten(), (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            place, chunk, before, behind, _ = (flat.field(i).to_pylist() for i in range(len(fields)))
            owners, rows, found = [], [], []
            for doc_id, text, low, high in zip(batch.column(0).to_pylist(), batch.column(1), edges, edges[1:], strict=False):
                data = text.as_py().encode("utf-8")
                starts, _ = line_ranges(data)
                known = dict(zip(*(a.tolist() for a in chunk_places(data.split())), strict=True))
                for i in range(low, high):
                    if known.get(place[i]) == chunk[i]:  # else of another row with this doc_id
                        owners.append(doc_id)
                        rows.append(i)
                        found.append(context(data, starts, place[i], before[i], behind[i]))
            asked = flat.take(pa.array(rows, pa.int64()))
            begin, given, whole = zip(*found, strict=True) if found else ((), (), ())
            columns = [pa.array(owners, pa.int64()), *(asked.field(i) for i in range(len(fields)))]
            columns += [pa.array(begin, pa.int32()), pa.array(given, pa.binary()), pa.array(whole, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["first_doc", *fields, "begin", "bytes", "whole"])

    schema = (
        "first_doc long, first_place int, chunk long, before int, behind int, copies int, begin int, bytes binary, whole boolean"
    )
    given = texts.mapInArrow(run, schema)
    dealt = given.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    mine = asked.withColumn("copy", F.pmod(F.xxhash64("doc_id", "place"), copies).cast("int"))
    met = mine.join(dealt, [*key, "copy"]).groupBy("doc_id")
    return met.agg(F.sort_array(F.collect_list(F.struct("place", "begin", "bytes", "whole"))).alias("found"))


def _cut(docs: DataFrame, found: str) -> DataFrame:
    """``docs`` (..., text) without the runs that the places in column ``found`` tell of; that column goes.

    Adds removed_chunks and removed_chars.
    """
    names = [c for c in docs.columns if c != found]
    schema = T.StructType(
        [*docs.select(names).schema.fields, T.StructField("removed_chunks", T.IntegerType()), T.StructField("removed_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, names.index("text"), _SLICE)):
            texts, runs, chars = [], [], []
            for text, places in zip(batch.column("text"), batch.column(found), strict=True):
                text, places = text.as_py(), places.as_py()
                gone = []
                if places and text is not None:
                    data = text.encode("utf-8")
                    gone = repeated_runs(data, [(f["place"], Context(f["begin"], f["bytes"], f["whole"])) for f in places])
                before = len(text or "")
                if gone:
                    at = [0, *(edge for run in gone for edge in run), len(data)]
                    text = b"".join(data[a:b] for a, b in zip(at[::2], at[1::2], strict=True)).decode("utf-8")
                texts.append(text)
                runs.append(len(gone))
                chars.append(before - len(text or ""))
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            columns += [pa.array(runs, pa.int32()), pa.array(chars, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "removed_chunks", "removed_chars"])

    return docs.mapInArrow(run, schema)


def without_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated passages taken out of the texts."""
    docs = docs.select([c for c in docs.columns if c not in ("removed_chunks", "removed_chars")])
    own, found, marked = (f"__{name}_{'_'.join(docs.columns)}" for name in ("id", "found", "marked"))  # no column's name
    texts = _texts(docs)
    chunks = written(chunk_table(texts), "line-chunks")
    asked = written(questions(later_places(chunks)), "chunk-places")
    told = written(answers(texts, asked), "chunk-answers").toDF(own, found)
    # Texts that surely have no repeated chunk are not shuffled.
    number = F.col("doc_id").cast("long")
    may_have = F.coalesce(possibly_in(number, told.select(own)), F.lit(False)) & number.isNotNull()
    all_docs = docs.withColumn(marked, may_have)
    rest = all_docs.where(~F.col(marked)).select(
        *docs.columns, F.lit(0).alias("removed_chunks"), F.lit(0).cast("long").alias("removed_chars")
    )
    joined = all_docs.where(marked).join(told, number == F.col(own), "left").select(*docs.columns, found)
    return _cut(joined, found).unionByName(rest)


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_chunks(docs)
