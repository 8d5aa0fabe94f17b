"""Fill-in-middle: documents cut into prefix, middle and suffix, put together in another order.

A text is a row of units: a word with the white space before it, or the white space that ends the text. A cut
lies after so many units, drawn from a hash of the document's id. Where that is comes from summaries of chunks:
a rolling hash over the last 32 bytes ends chunks by content, so a passage that many documents share is the same
chunks in all of them, and each chunk's summary (its words, and whether a word runs on over its ends) is made once
in a task and found again by the chunk's bytes, not by a hash of them. Adding summaries up gives the number of
words before each chunk, hence the number of units, and the one chunk in which a cut lies is looked into.

The cuts are all that leaves Python: texts are put together, and back, by Spark.

A text that is empty or holds a mark stays plain, as do those that the hash leaves so. NULL text is empty. A NULL
doc_id draws as the empty string; rows with equal doc_id draw alike. Texts of any length are cut whole, their hash
being rolled a block at a time. An empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import table, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: A chunk ends where so many bits of the rolling hash are zero, or at this many bytes.
CHUNK_BITS, LARGEST = 8, 4096
#: Bytes of chunks whose summaries a task remembers, and as many set aside.
REMEMBERED = 16 << 20
_REACH = 32
_BLOCK = 1 << 20
_GEAR = np.random.Generator(np.random.PCG64(12)).integers(0, 1 << 32, 256, dtype=np.uint32)
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").finditer
_WHITE_BYTES = frozenset(b" \t\n\x0b\x0c\r")


class Summary(NamedTuple):
    words: int
    starts_inside: bool
    ends_inside: bool


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end; depends on the 32 bytes before, and on the chunk's start by ``LARGEST`` alone."""
    marks: list[int] = []
    for begin in range(0, len(data), _BLOCK):
        lead = min(begin, _REACH - 1)
        rolled = _GEAR[np.frombuffer(data, np.uint8, min(_BLOCK, len(data) - begin) + lead, begin - lead)]
        reach = 1
        while reach < _REACH:  # each byte's gear moved left by one place per byte since, by doubling
            moved = rolled.copy()
            moved[reach:] += rolled[:-reach] << np.uint32(reach)
            rolled, reach = moved, reach * 2
        marks.extend((np.flatnonzero(rolled[lead:] >> np.uint32(32 - CHUNK_BITS) == 0) + begin + 1).tolist())
    if data and (not marks or marks[-1] < len(data)):
        marks.append(len(data))
    ends, start = [], 0
    for mark in marks:
        ends.extend(range(start + LARGEST, mark, LARGEST))
        ends.append(mark)
        start = mark
    return ends


def summary(chunk: bytes) -> Summary:
    return Summary(len(chunk.split()), chunk[0] not in _WHITE_BYTES, chunk[-1] not in _WHITE_BYTES)


class Summaries:
    """Summaries by the bytes of chunks, of at most ``REMEMBERED`` bytes of chunks and as many set aside."""

    def __init__(self) -> None:
        self.known: dict[bytes, Summary] = {}
        self.aside: dict[bytes, Summary] = {}
        self.held = 0

    def of(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            found = self.aside.get(chunk) or summary(chunk)
            if self.held > REMEMBERED:
                self.known, self.aside, self.held = {}, self.known, 0
            self.known[chunk] = found
            self.held += len(chunk) + 100
        return found


class Units:
    """The units of one text: their number, and where each ends."""

    def __init__(self, data: bytes, summaries: Summaries) -> None:
        self.data, self.ends = data, chunk_ends(data)
        self.goes_on: list[bool] = []  # whether the word at a chunk's start began before
        self.words: list[int] = []  # words that begin in the chunks up to each
        start, inside, total = 0, False, 0
        for end in self.ends:
            found = summaries.of(data[start:end])
            goes_on = inside and found.starts_inside
            total += found.words - goes_on
            self.goes_on.append(goes_on)
            self.words.append(total)
            start, inside = end, found.ends_inside
        self.count = total + (bool(data) and not inside)

    def end(self, number: int) -> int:
        """The byte at which the ``number``-th unit ends; 0 for none."""
        if number in (0, self.count):
            return len(self.data) if number else 0
        chunk = int(np.searchsorted(self.words, number))
        start = self.ends[chunk - 1] if chunk else 0
        nth = number - (self.words[chunk - 1] if chunk else 0) + self.goes_on[chunk]
        for found in _WORDS(self.data, start):
            nth -= 1
            if not nth:
                # The word may run on over further chunks; only a cut inside the text gets here.
                return found.end()
        raise AssertionError("fewer words than counted")


def cut(data: bytes, draws: tuple[int, int], summaries: Summaries) -> tuple[int, int, int]:
    """Number of units, and characters of prefix and middle."""
    units = Units(data, summaries)
    low, high = sorted(draw % (units.count + 1) for draw in draws)
    first, second = units.end(low), units.end(high)
    return units.count, len(data[:first].decode("utf-8")), len(data[first:second].decode("utf-8"))


_SUMMARIES = Summaries()


def _cuts(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    rows = [
        cut(text.encode("utf-8"), draws, _SUMMARIES)
        for text, *draws in zip(texts, first.tolist(), second.tolist(), strict=True)
    ]
    return pd.DataFrame(rows, columns=["n", "prefix", "middle"])


def draw(doc_id: Column, seed: int, number: int) -> Column:
    """The ``number``-th draw (from 0) of a document: 32 bits of a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) of every document (doc_id, text).

    ``percent`` of the documents are cut, ``spm_percent`` of these in suffix-prefix-middle order.
    """
    doc_id, text = F.col("doc_id").cast("long"), text_or_empty()
    draws = [draw(doc_id, seed, i) for i in range(4)]
    cuts = F.pandas_udf(_cuts, "n long, prefix long, middle long")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), cuts(text, draws[0], draws[1]).alias("cuts"))
    held = [F.contains("text", F.lit(mark)) for mark in (PREFIX, SUFFIX, MIDDLE)]
    doc_id = F.col("doc_id")
    plain = (F.col("text") == "") | held[0] | held[1] | held[2] | (draw(doc_id, seed, 2) % 100 >= percent)
    form = F.when(plain, PLAIN).when(draw(doc_id, seed, 3) % 100 < spm_percent, SPM).otherwise(PSM)
    rows = rows.select("doc_id", "text", F.col("cuts.n").alias("n"), form.alias("form"), "cuts.prefix", "cuts.middle")
    first, second = F.col("prefix"), F.col("prefix") + F.col("middle")
    prefix = F.expr("substr(text, 1, prefix)")
    middle = F.expr("substr(text, prefix + 1, middle)")
    suffix = F.expr("substr(text, prefix + middle + 1)")
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = (
        F.when(F.col("form") == PSM, F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == SPM, F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("text"))
    )
    is_cut = F.col("form") != PLAIN
    return rows.select(
        "doc_id",
        "text",
        "n",
        "form",
        F.when(is_cut, first).alias("prefix_chars"),
        F.when(is_cut, second - first).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of. No text that was cut holds a mark, so marks part it."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (
        F.when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in the order for training and put back."""
    done = fill_in_middle(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
