"""Language-model scores from a weighted backoff automaton.

Words are runs of anything but space and the controls 9 to 13, with A-Z in lower case; a text's last token is
its end. All tokens and all n-grams of the training texts are counted. An n-gram is kept if it occurs at least
twice, and so do its shorter parts then. Interpolated absolute discounting, by the numbers of all n-grams that
occur once and twice, gives the probabilities: what the kept followers of a history lose is its backoff weight, which is shared out
by the distribution one word shorter, down to add-one estimates of single words, in which all unseen words
together count as one more.

States of the automaton are the kept histories. An arc reads a word, carries its log probability and leads to
the longest kept history that the text now ends with. Where a state has no arc for a word, the failure arc
carries the backoff weight to the next shorter history. A text's tokens are read from left to right, stretches
of many texts in step; a stretch begins as many tokens early as a history is long, so its state is the one that
a walk from the beginning has there.

All kept n-grams over all words are in tables, whose size follows the input. The automaton holds the most frequent
of them only (``LEXICON_WORDS``, ``ARCS`` of each order, and the words these n-grams bring with them), so it is a file
of fixed greatest size that executors memory-map. A score is a sum over the n-grams of a text: the log probability
of an n-gram less that of the same word after the shorter history, and less the backoff weight of its history; as each
history is followed by one token, its own backoff weight counts with it. What the automaton lacks is therefore a
sum of weights that are joined from the tables, and scores do not depend on the automaton's bounds.

Words in tables of n-grams, and words of texts when they are looked up, are 64-bit hashes; two of 50 million words share one
with a chance of 1 in 14,000. So are the n-grams that texts and weights are joined by: one that is not kept has the weight of
one of a billion kept with a chance of 1 in 18 billion. N-grams are counted by their own key and that of their words but the last.

Texts are cut into words and hashed in bulk. N-grams do not travel as rows: a task sorts its own, packs those of each part of
all keys into one row, and a part is sorted and summed, or joined, by one task.

A NULL or empty text is its end alone. Rows with NULL id are learned from. Repeated rows count and are
scored each. Over an empty table the result is empty; with nothing to learn from, every token costs 0.
"""

from __future__ import annotations

import gc
import math
import time
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import (
    FILTER_BITS,
    bit_array,
    forget,
    frequent,
    let_go,
    mapped,
    shared_file,
    shuffle_tasks,
    slices,
    table,
    text_or_empty,
    to_file,
    written,
)
from tripmill.llm.language import remainder

ORDER = 3
LEXICON_WORDS = 1 << 17
ARCS = 1 << 19
#: Words are numbered below this, and a state and a word make one key.
_WORD_BITS = 22
STRETCH = 128
_FLUSH_WORDS = 1 << 22
_FLUSH_GRAMS = 1 << 21
_SLICE = 1 << 21
#: Tokens of the training texts, or weights, for which there is one more part of n-grams.
_PART = 1 << 21
#: Slices by key in which the keys of texts are joined with the weights of the tables.
KEY_SLICES = 4
END = b""


def words_of(text: str) -> list[bytes]:
    """The tokens of a text; the end is the empty string."""
    # Lower-casing and splitting of bytes know ASCII only: A-Z, and the six white-space characters.
    return [*text.encode("utf-8").lower().split(), END]


def _give_back(spark: SparkSession) -> None:
    """Remove shuffle files of steps that are over: ``let_go``, once nothing in Python refers to their tables, and again
    when the listeners have handled the steps' ends, which refer to them too."""
    gc.collect()
    for _ in range(2):
        time.sleep(0.3)
        let_go(spark)


_SPACE = ord(" ")
#: Bytes in lower case, all white space as one.
_FOLDED = bytes(_SPACE if bytes([i]).isspace() else i for i in bytes(range(256)).lower())
#: Keeps so many of eight bytes.
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
#: Longer words are hashed one by one.
_LONG = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits mixed so that each depends on all, one to one."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = x ^ x >> np.uint64(33)
        x *= np.uint64(factor)
    return x ^ x >> np.uint64(33)


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits for each of the words that stand in ``data``, behind which there are eight more bytes."""
    eight = np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))
    found = _mixed((lengths + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ eight[starts] & _MASKS[np.minimum(lengths, 8)])
    more = np.flatnonzero((lengths > 8) & (lengths <= _LONG))
    done = 8
    while len(more):
        left = lengths[more] - done
        found[more] = _mixed(found[more] * np.uint64(0x2545F4914F6CDD1D) ^ eight[starts[more] + done] & _MASKS[np.minimum(left, 8)])
        more, done = more[left > 8], done + 8
    for i in np.flatnonzero(lengths > _LONG).tolist():
        found[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]])
    return found.view(np.int64)


END_HASH = int(_hashes(np.zeros(8, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))[0])


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of many texts as ``words_of`` has them, without ends: their bytes in lower case with eight more behind,
    where each word starts in them, its length, and the number of words of each text."""
    n = len(texts)
    _, offsets, data = texts.buffers()
    kind = np.dtype(np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = np.frombuffer(offsets, kind, n + 1, kind.itemsize * texts.offset).astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]) if offsets[-1] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = np.frombuffer(data.tobytes().translate(_FOLDED) + bytes(8), np.uint8)
    word = data[:-8] != _SPACE
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(word))]
    first[edges], last[edges - 1] = word[edges], word[edges - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    return data, starts, lengths, np.diff(np.searchsorted(starts, offsets))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the tokens of many texts, one text after the other with its end, and the tokens of each."""
    data, starts, lengths, counts = _words(texts)
    flat = np.full(len(starts) + len(counts), END_HASH, dtype=np.int64)
    flat[np.arange(len(starts)) + np.repeat(np.arange(len(counts)), counts)] = _hashes(data, starts, lengths)
    return flat, counts + 1


def token_counts(texts: DataFrame) -> DataFrame:
    """(a, word, n) of every token of ``texts`` (text), a being the hash of its word; summed in the task first."""

    def rows(parts: list[pa.Array], ends: int) -> pa.RecordBatch:
        found = pc.value_counts(pa.chunked_array([*parts, pa.array([], pa.binary())]))
        words, n = found.field(0), found.field(1).cast(pa.int64())
        if ends:
            words, n = pa.concat_arrays([words, pa.array([END])]), pa.concat_arrays([n, pa.array([ends])])
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int32, len(words) + 1).astype(np.int64) if len(words) else np.zeros(1, np.int64)
        data = np.concatenate([np.frombuffer(data or b"", np.uint8), np.zeros(8, np.uint8)])
        hashes = _hashes(data, offsets[:-1], np.diff(offsets))
        return pa.RecordBatch.from_arrays([pa.array(hashes), words, n], names=["a", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Array] = []
        held = ends = 0
        for batch in batches:
            for piece in slices(batch, 0, _SLICE):
                data, starts, lengths, counts = _words(piece.column(0))
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                text = data[:-8][data[:-8] != _SPACE]
                parts.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text)]))
                held, ends = held + len(starts), ends + len(counts)
                if held > _FLUSH_WORDS:
                    yield rows(parts, ends)
                    parts, held, ends = [], 0, 0
        yield rows(parts, ends)

    counted = texts.mapInArrow(count, "a long, word binary, n long")
    return counted.groupBy("a", "word").agg(F.sum("n").alias("n"))


class _Places:
    """Finds the places of 64-bit keys by open addressing."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.table = np.full(1 << bits, -1, dtype=np.int32)
        slots, left = self._slots(keys), np.arange(len(keys), dtype=np.int32)
        while len(left):
            free = left[self.table[slots[left]] < 0]
            self.table[slots[free]] = free
            left = left[self.table[slots[left]] != left]
            slots[left] = slots[left] + 1 & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        keys = np.ascontiguousarray(keys, dtype=np.int64).view(np.uint64)
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each of ``keys``, -1 if it is not there."""
        slots = self._slots(keys)
        found = self.table[slots].astype(np.int64)
        open_ = np.flatnonzero(found >= 0)
        open_ = open_[self.keys[found[open_]] != keys[open_]]
        while len(open_):
            slots[open_] = slots[open_] + 1 & self.last
            found[open_] = self.table[slots[open_]]
            open_ = open_[found[open_] >= 0]
            open_ = open_[self.keys[found[open_]] != keys[open_]]
        return found


class Automaton:
    """States are numbers: 0 is the root, 1 + w the history of word w alone, then the longer ones."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        arrays = {name: np.asarray(column) for name, column in arrays.items()}  # mapped as before; np.memmap is slow on small steps
        self.keys, self.targets, self.costs = arrays["keys"], arrays["targets"], arrays["costs"]
        self.fails, self.backoffs = arrays["fails"], arrays["backoffs"]
        self.hashes = arrays["hashes"]
        self.arcs, self.words = _Places(self.keys), _Places(self.hashes)

    def arc(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the arc that reads each word in its state, and whether there is one."""
        place = np.where(states == 0, words, -1)  # the root's arcs come first, in order of words
        others = np.flatnonzero((states != 0) & (words >= 0))
        place[others] = self.arcs.find(states[others] << _WORD_BITS | words[others])
        return np.maximum(place, 0), place >= 0

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after reading a word each, and the log probabilities met on the way."""
        return self._step(states, words)[:2]

    def _step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``step``, and the order of the n-gram whose arc was taken, 0 if there was none."""
        states, costs, orders = states.copy(), np.zeros(len(states)), np.zeros(len(states), np.int8)
        open_ = np.arange(len(states))
        while len(open_):
            place, found = self.arc(states[open_], words[open_])
            taken = open_[found]
            costs[taken] += self.costs[place[found]]
            orders[taken] = 1 + (states[taken] > 0) + (states[taken] > len(self.hashes))
            states[taken] = self.targets[place[found]]
            open_ = open_[~found]
            open_ = open_[states[open_] != 0]  # words without an arc at the root end there
            costs[open_] += self.backoffs[states[open_]]
            states[open_] = self.fails[states[open_]]
        return states, costs, orders

    def read(self, flat: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The summed log probability of each of the texts of ``sizes`` tokens that stand in ``flat``, and the order of each arc."""
        bases = np.cumsum(sizes) - sizes
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        first = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STRETCH
        early = np.minimum(first, order - 1)
        begin = bases[owner] + first - early
        length = np.minimum(STRETCH, sizes[owner] - first) + early
        lanes = np.argsort(-length, kind="stable")
        begin, length, early, owner = begin[lanes], length[lanes], early[lanes], owner[lanes]
        states, totals = np.zeros(len(lanes), dtype=np.int64), np.zeros(len(lanes))
        active, orders = len(lanes), np.zeros(len(flat), np.int8)
        for at in range(int(length[0]) if active else 0):
            while length[active - 1] <= at:
                active -= 1
            places = begin[:active] + at
            states[:active], costs, taken = self._step(states[:active], flat[places])
            if at < order:
                own = at >= early[:active]
                places, costs, taken = places[own], np.where(own, costs, 0.0), taken[own]
            totals[:active] += costs
            orders[places] = taken
        return np.bincount(owner, totals, len(sizes)) if len(sizes) else np.zeros(0), orders


_AUTOMATA: dict[str, Automaton] = {}


def _opened(name: str) -> Automaton:
    if name not in _AUTOMATA:
        _AUTOMATA[name] = Automaton(mapped(SparkFiles.get(name)))
    return _AUTOMATA[name]


def _turned(word: np.ndarray | Column, bits: int) -> np.ndarray | Column:
    if isinstance(word, Column):
        return F.shiftleft(word, bits).bitwiseOR(F.shiftrightunsigned(word, 64 - bits))
    word = word.view(np.uint64)
    return (word << np.uint64(bits) | word >> np.uint64(64 - bits)).view(np.int64)


#: By how many bits a word is turned in the key of an n-gram that begins a word before.
_TURN = 21


def _key(words: list) -> np.ndarray | Column:
    """64 bits for an n-gram of up to three words, given by their hashes.

    The key gives the last word's hash if one knows the key of the words before it, and the key of the
    words behind the first one if one knows the first word's hash.
    """
    key = words[0]
    for k, word in enumerate(words[1:], 1):
        turned = _turned(word, k * _TURN)
        key = key.bitwiseXOR(turned) if isinstance(key, Column) else key ^ turned
    return key


def _place(key: np.ndarray | Column) -> np.ndarray | Column:
    """The bit of an n-gram in a filter, by its key."""
    if isinstance(key, Column):
        return F.shiftright(key, 3).bitwiseAND(F.lit(FILTER_BITS - 1))
    return key >> 3 & (FILTER_BITS - 1)


def _bits(keys: DataFrame) -> Broadcast:
    return keys.sparkSession.sparkContext.broadcast(bit_array(keys.select(_place(F.col(keys.columns[0]))), FILTER_BITS))


def _may_be(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    p = _place(keys)
    return bits[p >> 6] >> (p & 63) & 1 == 1


def _starts(sizes: np.ndarray, order: int) -> np.ndarray:
    """Places in texts of ``sizes`` tokens, one after the other, at which an n-gram starts."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.flatnonzero(owner[: max(len(owner) - order + 1, 0)] == owner[order - 1 :])


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of as many 64-bit numbers, least bytes first, without the bytes that are zero in a whole column."""
    parts = [len(columns[0]).to_bytes(8, "little")]
    for column in columns:
        column = np.ascontiguousarray(column).view(np.uint64)
        width = (int(column.max(initial=0)).bit_length() + 7) // 8
        parts += [bytes([width]), column.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    return b"".join(parts)


def _unpacked(packed: bytes) -> list[np.ndarray]:
    """The columns that ``_packed`` was given, as unsigned numbers."""
    n, at, columns = int.from_bytes(packed[:8], "little"), 8, []
    while at < len(packed):
        width = packed[at]
        column = np.zeros((n, 8), dtype=np.uint8)
        column[:, :width] = np.frombuffer(packed, np.uint8, n * width, at + 1).reshape(width, n).T
        columns.append(column.reshape(-1).view("<u8"))
        at += 1 + n * width
    return columns


def _edges(parts: int) -> np.ndarray:
    """The least key of each of ``parts`` parts of all 64-bit keys, by their unsigned values."""
    return ((np.arange(parts, dtype=np.uint64) << np.uint64(32)) + np.uint64(parts - 1)) // np.uint64(parts) << np.uint64(32)


def _dealt(keys: np.ndarray, edges: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Sorted unsigned ``keys`` and what stands beside them: the number of each part that has some, and its rows packed."""
    ends = np.append(np.searchsorted(keys, edges), len(keys))
    steps = np.diff(keys, prepend=np.uint64(0))
    for part in np.flatnonzero(np.diff(ends)).tolist():
        start, stop = ends[part], ends[part + 1]
        own = steps[start:stop].copy()
        own[0] = keys[start] - edges[part]
        yield part, _packed(own, *(c[start:stop] for c in columns))


def _taken(part: int, packed: bytes, edges: np.ndarray) -> list[np.ndarray]:
    """The rows that ``_dealt`` packed: sorted keys, and the columns beside them."""
    steps, *columns = _unpacked(packed)
    return [edges[part] + np.cumsum(steps, dtype=np.uint64), *columns]


def _order(keys: np.ndarray) -> np.ndarray:
    """As np.argsort of unsigned ``keys``, several times as fast on keys that are hashes: places stand in their low bits."""
    bits = np.uint64(len(keys).bit_length())
    order = keys >> bits << bits | np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order = (order & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)
    found = keys[order]
    if (found[1:] < found[:-1]).any():  # keys that differ in the low bits only
        order = order[np.argsort(found, kind="stable")]
    return order


def _summed(keys: np.ndarray, left: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (keys, left) in order of keys, once each, with the sum of ``n``, or how often they stand there."""
    order = _order(keys)
    if ((keys[order[1:]] == keys[order[:-1]]) & (left[order[1:]] != left[order[:-1]])).any():
        order = np.lexsort((left, keys))
    keys, left = keys[order], left[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (left[1:] != left[:-1])
    first = np.flatnonzero(new)
    total = np.diff(first, append=len(keys)) if n is None else np.add.reduceat(n[order], first) if len(first) else n[:0]
    return keys[first], left[first], total


def _none(names: int) -> list[np.ndarray]:
    return [np.zeros(0, np.uint64) for _ in range(names)]


def gram_counts(texts: DataFrame, shorter: Broadcast, order: int, parts: int) -> DataFrame:
    """(part, grams, once, twice): for each part its n-grams of ``order`` that occur at least twice, packed (key, first, n).

    ``key`` is that of the n-gram and ``first`` that of all its words but the last.
    Rows without a part have the numbers of n-grams that occur once and twice.

    ``shorter`` has the bits of the next shorter n-grams that occur at least twice: an n-gram with another part
    occurs once, and is counted in its task without being dealt out. The others are dealt by key to ``parts`` parts,
    sorted and packed: a shuffle has a row for each part of each task, and a part is sorted by one task.
    """
    edges = _edges(parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shorter.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = once = 0

        def rows() -> Iterator[pa.RecordBatch]:
            keys, first, n = _summed(*(np.concatenate(c) for c in zip(_none(2), *held, strict=True)))
            for part, packed in _dealt(keys, edges, first, n):
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "once": [0], "grams": [packed]})

        for batch in batches:
            for piece in slices(batch, 0, _SLICE):
                flat, sizes = _tokens(piece.column(0))
                at = _starts(sizes, order)
                first = _key([flat[at + k] for k in range(order - 1)])
                good = _may_be(bits, first) & _may_be(bits, _key([flat[at + k] for k in range(1, order)]))
                first, last = first[good], flat[at[good] + order - 1]
                held.append(((first ^ _turned(last, (order - 1) * _TURN)).view(np.uint64), first.view(np.uint64)))
                size, once = size + len(first), once + len(at) - len(first)
                if size > _FLUSH_GRAMS:
                    yield from rows()
                    held, size = [], 0
        yield from rows()
        yield pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "once": [once], "grams": pa.array([None], pa.binary())})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        once = 0
        for batch in batches:
            once += pc.sum(batch.column(1)).as_py() or 0
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if packed.is_valid:
                    found.setdefault(part, []).append(packed.as_py())
        twice = 0
        for part in list(found):
            rows = [_taken(part, packed, edges) for packed in found.pop(part)]
            keys, first, n = _summed(*(np.concatenate(c) for c in zip(*rows, strict=True)))
            del rows
            once, twice, kept = once + int((n == 1).sum()), twice + int((n == 2).sum()), n > 1
            for _, packed in _dealt(keys[kept], edges, first[kept], n[kept]):
                yield made(part, packed, None, None)
        yield made(None, None, once, twice)

    def made(part: int | None, packed: bytes | None, once: int | None, twice: int | None) -> pa.RecordBatch:
        counts = [pa.array([x], pa.int64()) for x in (once, twice)]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary()), *counts], names=names)

    names = ["part", "grams", "once", "twice"]
    dealt = texts.mapInArrow(deal, "part int, once long, grams binary")
    return dealt.repartitionById(parts, F.col("part")).mapInArrow(gather, "part int, grams binary, once long, twice long")


def repeated_grams(texts: DataFrame, shorter: Broadcast, order: int, parts: int) -> tuple[DataFrame, float]:
    """(part, grams) of the n-grams of ``order`` that occur at least twice, written, and what is taken from each n.

    Those that occur once or twice are counted as the others are written, in the write's last stage.
    """
    observed = Observation()
    counted = gram_counts(texts, shorter, order, parts)
    counted = counted.observe(observed, F.sum("once").alias("once"), F.sum("twice").alias("twice"))
    kept = written(counted.where("part IS NOT NULL").select("part", "grams"), "gram-counts")
    once, twice = int(observed.get["once"] or 0), int(observed.get["twice"] or 0)
    del counted, observed
    _give_back(texts.sparkSession)
    return kept, once / max(once + 2 * twice, 1) or 0.5


def _packets(edges: np.ndarray, held: list[list[np.ndarray]], base: int | None) -> Iterator[pa.RecordBatch]:
    """Rows of a key and other 64-bit columns, packed for each part."""
    keys, *columns = (np.concatenate(c).view(np.uint64) for c in zip(*held, strict=True))
    order = _order(keys)
    for part, packed in _dealt(keys[order], edges, *(c[order] for c in columns)):
        base_ = pa.array([base], pa.int64())
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "base": base_, "packed": [packed]})


_PACKETS = "part int, base long, packed binary"


def _columns(batch: pa.RecordBatch) -> list[list[np.ndarray]]:
    return [[c.to_numpy(zero_copy_only=False) for c in batch.columns]]


def _sent(rows: DataFrame, edges: np.ndarray, base: int | None, columns: Callable = _columns) -> DataFrame:
    """``rows`` (key, ...) of 64-bit columns without NULL, as packets for the parts that hold their keys.

    ``columns`` gives the columns of a batch, in one or more pieces.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held += columns(batch)
            if sum(len(h[0]) for h in held) > _FLUSH_GRAMS:
                yield from _packets(edges, held, base)
                held = []
        if held:
            yield from _packets(edges, held, base)

    return rows.mapInArrow(send, _PACKETS)


def _sorted(part: int, packets: list[bytes], edges: np.ndarray, columns: int) -> list[np.ndarray]:
    """All rows of ``packets``, in order of their keys."""
    taken = [_none(columns), *(_taken(part, packed, edges) for packed in packets)]
    keys, *rest = (np.concatenate(c) for c in zip(*taken, strict=True))
    order = _order(keys)
    return [keys[order], *(c[order] for c in rest)]


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and which of them are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def _gathered(batches: Iterator[pa.RecordBatch], edges: np.ndarray, *sizes: int) -> Iterator[list[list[np.ndarray]]]:
    """For each part the rows of its packets, by the sides that these name as their base, which have ``sizes`` columns."""
    found: dict[int, list[list[bytes]]] = {}
    for batch in batches:
        for part, side, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found.setdefault(part, [[] for _ in sizes])[side].append(packed)
    for part in list(found):
        yield [_sorted(part, packets, edges, n) for packets, n in zip(found.pop(part), sizes, strict=True)]


def _weights(counted: DataFrame, histories: DataFrame, shorter: DataFrame, discount: float, parts: int) -> DataFrame:
    """(key, after, n, more, cost) of the n-grams of ``counted``, and rows with n = 0, a history as key and its backoff weight as more.

    ``histories`` are (history, n, word), word being its first one, and ``shorter`` (key, cost) those n-grams that
    are left without the first word, ``after`` being their key. ``cost`` is the log probability, and ``more`` what it is over that of
    the shorter n-gram with the history's backoff weight.

    N-grams meet their history first, which gives what its kept followers leave, and the shorter n-gram then. Each time
    both sides are dealt by key, sorted and packed, so a shuffle holds few bytes more than the numbers need.
    """
    edges = _edges(parts)

    def grams(batch: pa.RecordBatch) -> list[list[np.ndarray]]:
        taken = (_taken(part, packed, edges) for part, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        return [[first, keys, n] for keys, first, n in taken]

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, (known, times, words) in _gathered(batches, edges, 3, 3):
            place, hit = _places(known, rows[0])
            history, keys, n, place = *(c[hit] for c in rows), place[hit]
            if not len(keys):
                continue
            first = np.flatnonzero(np.append(True, history[1:] != history[:-1]))
            spent = np.add.reduceat(n - discount, first)
            rest = np.maximum(1.0 - spent / times[place[first]], 1e-12)
            own = np.repeat(rest, np.diff(first, append=len(history)))
            after = _turned((keys ^ words[place]).view(np.int64), 64 - _TURN)
            yield from _packets(edges, [[after, keys, n, (n - discount) / times[place] / own, own]], 0)
            yield from _packets(edges, [[history[first], rest]], 2)

    def back_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, (known, costs), (history, left) in _gathered(batches, edges, 5, 2, 2):
            place, hit = _places(known, rows[0])
            after, keys, n, shares, rest = (c[hit] for c in rows)
            base = costs.view(np.float64)[place[hit]]
            more, none = np.log10(shares.view(np.float64) / 10.0**base + 1.0), np.zeros(len(history), np.int64)
            columns = {
                "key": np.concatenate([keys, history]).view(np.int64),
                "after": np.concatenate([after.view(np.int64), none]),
                "n": np.concatenate([n.view(np.int64), none]),
                "more": np.concatenate([more, np.log10(left.view(np.float64))]),
                "cost": np.concatenate([more + np.log10(rest.view(np.float64)) + base, none]),
            }
            yield from pa.table(columns).to_batches(1 << 16)

    both = _sent(counted, edges, 0, grams).union(_sent(histories, edges, 1))
    shares = both.repartitionById(parts, F.col("part")).mapInArrow(share, _PACKETS)
    both = shares.union(_sent(shorter, edges, 1))
    return both.repartitionById(parts, F.col("part")).mapInArrow(back_off, "key long, after long, n long, more double, cost double")


def _first(key: np.ndarray | Column, after: np.ndarray | Column) -> np.ndarray | Column:
    """The hash of an n-gram's first word, given its key and that of the words behind it."""
    turned = _turned(after, _TURN)
    return key.bitwiseXOR(turned) if isinstance(key, Column) else key ^ turned


def _numpy(rows: DataFrame) -> dict[str, np.ndarray]:
    found = rows.toArrow()
    return {name: found.column(name).to_numpy() for name in found.column_names}


class LanguageModel:
    """Counts of all training tokens, weights of all kept n-grams, the automaton's file, and its words' numbers."""

    def __init__(self, texts: DataFrame) -> None:
        spark = texts.sparkSession
        self.order = ORDER
        counts = written(token_counts(texts), "token-counts")
        tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.tokens, self.outcomes = int(tokens), int(tokens) + int(distinct) + 1
        parts = max(shuffle_tasks(spark), self.tokens // _PART)
        self.counts = counts.withColumn("cost", F.log10((F.col("n") + 1) / F.lit(float(self.outcomes))))
        words = self.counts.where("n > 1")

        counted, discount = repeated_grams(texts, _bits(words.select("a")), 2, parts)
        weighted_pairs = _weights(counted, words.select("a", "n", F.col("a").alias("word")), words.select("a", "cost"), discount, parts)
        weighted_pairs = written(weighted_pairs, "pairs")
        forget(counted)
        _give_back(spark)
        self.word_backs = weighted_pairs.where("n = 0").select(F.col("key").alias("a"), F.col("more").alias("back"))
        pairs = weighted_pairs.where("n > 0")

        counted, discount = repeated_grams(texts, _bits(pairs), 3, parts)
        word = _first(F.col("key"), F.col("after"))
        weighted_triples = _weights(counted, pairs.select("key", "n", word.alias("word")), pairs.select("key", "cost"), discount, parts)
        weighted_triples = written(weighted_triples.drop("cost"), "triples")
        forget(counted)
        _give_back(spark)
        backs = weighted_triples.where("n = 0").select("key", F.col("more").alias("back"))
        triples = weighted_triples.where("n > 0")

        self.repeated = {2: _bits(pairs), 3: _bits(triples)}
        arrays = self._frequent(words, pairs, backs, triples)
        weights = pairs.select("key", F.col("more").alias("weight")).union(weighted_triples.select("key", "more"))
        self.weights = written(weights, "weights")
        self.word_backs = written(self.word_backs, "backoffs")
        forget(weighted_pairs, weighted_triples)
        _give_back(spark)
        self.name = shared_file(spark, to_file(arrays), "backoff")

    def _frequent(self, words: DataFrame, pairs: DataFrame, backs: DataFrame, triples: DataFrame) -> dict[str, np.ndarray]:
        """The automaton of the most frequent n-grams and their words; costs and backoff weights are those of all."""
        pairs = pairs.select("key", "n", "cost", _first(F.col("key"), F.col("after")).alias("a"), F.col("after").alias("b"))
        often = frequent(pairs, ARCS, ["key"])
        brought = often.select("a").union(often.select("b")).distinct()
        lexicon = words.join(brought, "a", "left_semi").union(frequent(words, LEXICON_WORDS, ["a"])).join(self.word_backs, "a", "left")
        lexicon = lexicon.select("word", "a", "cost", F.coalesce("back", F.lit(0.0)).alias("back")).distinct().toArrow()
        self.number = {word: i for i, word in enumerate(lexicon.column("word").to_pylist())}
        hashes, costs_of_words, backs_of_words = (lexicon.column(c).to_numpy() for c in ("a", "cost", "back"))
        size = len(hashes)
        numbers = _Places(hashes).find

        two = _numpy(often.join(backs, "key", "left").select("key", "a", "b", "cost", F.coalesce("back", F.lit(0.0)).alias("back")))
        a, b = numbers(two["a"]), numbers(two["b"])
        keys = a + 1 << _WORD_BITS | b
        by_key = np.argsort(keys)
        keys, b, two = keys[by_key], b[by_key], {name: column[by_key] for name, column in two.items()}
        ends = b + 1
        three = _numpy(frequent(triples, ARCS, ["key"]).select("key", "after", "more"))
        right = _Places(two["key"]).find(three["after"])
        middle = np.append(a[by_key], -1)[right]
        first, c = numbers(_first(three["key"], three["after"])), np.append(b, -1)[right]
        left = np.where((first >= 0) & (middle >= 0), _Places(keys).find(first + 1 << _WORD_BITS | np.maximum(middle, 0)), -1)
        whole = (left >= 0) & (right >= 0)
        states = size + 1 + left[whole]
        triple_keys = states << _WORD_BITS | c[whole]
        costs = three["more"][whole] + two["back"][left[whole]] + two["cost"][right[whole]]
        by_triple = np.argsort(triple_keys)
        return {
            "keys": np.concatenate([np.arange(size, dtype=np.int64), keys, triple_keys[by_triple]]),
            "targets": np.concatenate([np.arange(size, dtype=np.int64) + 1, size + 1 + np.arange(len(keys)), size + 1 + right[whole][by_triple]]),
            "costs": np.concatenate([costs_of_words, two["cost"], costs[by_triple]]),
            "fails": np.concatenate([np.zeros(size + 1, dtype=np.int64), ends]),
            "backoffs": np.concatenate([[0.0], backs_of_words, two["back"]]),
            "hashes": hashes,
        }


def _bytes(flat: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """For each of ``n`` owners the bytes of its numbers in ``flat``; ``owner`` is in order."""
    ends = 8 * np.searchsorted(owner, np.arange(n + 1))
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))]
    return pa.Array.from_buffers(pa.large_binary(), n, buffers).cast(pa.binary())


def _keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The keys of many rows, which have them in lists or as bytes, one row after the other, and how many each has."""
    if pa.types.is_list(column.type):
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        return pc.list_flatten(column).to_numpy(zero_copy_only=False), lengths
    _, offsets, data = column.cast(pa.large_binary()).buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0]) // 8
    return np.frombuffer(data, np.int64, size, int(offsets[0])) if size else np.zeros(0, np.int64), np.diff(offsets) // 8


def _looked_up(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(row, hits, ...): per row of ``asked`` (row, keys) how many of its keys ``known`` (key, ...) has, and the sums over
    these of the other columns, which are doubles; rows without any are left out. Rows of ``known`` with the same key add up.

    Keys of both sides are dealt to the same parts, sorted and packed, and looked up by one task each; what it finds
    for a row goes, packed with that of the rows around it, to the task that adds up these rows.
    """
    names = [c for c in known.columns if c != "key"]
    parts = max(shuffle_tasks(known.sparkSession), known.count() // _PART)
    edges = _edges(parts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flushed() -> Iterator[pa.RecordBatch]:
            base = min((int(rows.min()) for _, rows in held if len(rows)), default=0)
            yield from _packets(edges, [[keys, rows - base] for keys, rows in held], base)

        for batch in batches:
            keys, lengths = _keys_of(batch.column(1))
            held.append([keys, np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lengths)])
            if sum(len(h[0]) for h in held) > _FLUSH_GRAMS:
                yield from flushed()
                held = []
        if held:
            yield from flushed()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for part, base, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tables, questions = found.setdefault(part, ([], []))
                (tables if base is None else questions).append((base, packed))
        for part in list(found):
            tables, questions = found.pop(part)
            keys, *columns = _sorted(part, [packed for _, packed in tables], edges, 1 + len(names))
            if not len(keys):
                continue
            new = np.append(True, keys[1:] != keys[:-1])
            columns = [np.add.reduceat(c.view(np.float64), np.flatnonzero(new)) for c in columns]
            keys = keys[new]
            for base, packed in questions:
                wanted, rows = _taken(part, packed, edges)
                place, hit = _places(keys, wanted)
                if hit.any():
                    answers = _packed(rows[hit], *(c[place[hit]] for c in columns))
                    yield pa.RecordBatch.from_pydict({"base": pa.array([base], pa.int64()), "packed": [answers]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for base, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault(base, []).append(packed)
        for base in list(found):
            rows, *columns = (np.concatenate(c) for c in zip(*map(_unpacked, found.pop(base)), strict=True))
            rows = rows.astype(np.int64)
            if rows.max() > 4 * len(rows) + _FLUSH_WORDS:
                own, rows = np.unique(rows, return_inverse=True)
            else:
                own = np.arange(rows.max() + 1)
            hits = np.bincount(rows)
            sums = [np.bincount(rows, c.view(np.float64))[hits > 0] for c in columns]
            arrays = [own[hits > 0] + base, hits[hits > 0], *sums]
            yield from pa.table([pa.array(x) for x in arrays], names=["row", "hits", *names]).to_batches(1 << 16)

    both = asked.mapInArrow(ask, _PACKETS).union(_sent(known.select("key", *names), edges, None))
    answers = both.repartitionById(parts, F.col("part")).mapInArrow(look, "base long, packed binary")
    return answers.repartition(parts, "base").mapInArrow(add, ", ".join(["row long, hits long", *(f"{x} double" for x in names)]))


def _weighed(walked: DataFrame, weights: DataFrame) -> DataFrame:
    """(row, weight): per row the sum of the weights of its keys that the tables hold.

    Keys are looked up in ``KEY_SLICES`` slices by their value, each summed by row and written before the next, so
    the shuffle files of one slice only are on disk at a time; every key is in exactly one slice. ``keys`` are lists of
    numbers, or have the bytes of the numbers of each slice.
    """
    spark, by_slice = walked.sparkSession, dict(walked.dtypes)["keys"] == "array<binary>"
    sums = []
    for k in range(KEY_SLICES):

        def mine(batches: Iterator[pa.RecordBatch], k: int = k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, lengths = _keys_of(batch.column(1))
                good = keys % KEY_SLICES == k
                own = _bytes(keys[good], np.repeat(np.arange(len(lengths)), lengths)[good], len(lengths))
                yield pa.RecordBatch.from_arrays([batch.column(0), own], names=["row", "keys"])

        if by_slice:
            keys = walked.select("row", F.col("keys")[k].alias("keys"))
        else:
            keys = walked.select("row", "keys").mapInArrow(mine, "row long, keys binary")
        found = _looked_up(keys, weights.where(F.pmod(F.col("key"), F.lit(KEY_SLICES)) == k))
        sums.append(written(found.select("row", "weight"), "weighed"))
        del keys, found
        _give_back(spark)
    return reduce(DataFrame.union, sums)


def score(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every text of ``docs``."""
    name, order, repeated = model.name, model.order, model.repeated
    size, unseen = len(model.number), -math.log10(model.outcomes)

    def others(taken: np.ndarray, owner: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> pa.Array:
        """For each text the keys, by slices, of n-grams that the automaton lacks and the tables may have."""
        owners, keys = [], []
        for k in range(2, order + 1):
            at = _starts(sizes, k)
            at = at[taken[at + k - 1] < k]
            key = _key([hashes[at + i] for i in range(k)])
            may_be = _may_be(repeated[k].value, key)
            owners.append(owner[at[may_be]])
            keys.append(key[may_be])
        key, places = np.concatenate(keys), len(sizes) * KEY_SLICES
        place = np.concatenate(owners) * KEY_SLICES + key % KEY_SLICES
        place = place.astype(np.uint16 if places <= 1 << 16 else np.int64)  # sorted by digits if they are short
        by_place = np.argsort(place, kind="stable")
        starts = np.arange(0, places + 1, KEY_SLICES, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(starts), _bytes(key[by_place], place[by_place].astype(np.int64), places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _opened(name)
        alone = np.append(automaton.costs[:size], 0.0)  # the root's arcs have the smallest keys
        row = TaskContext.get().partitionId() << 40
        for batch in (piece for batch in batches for piece in slices(batch, 1, _SLICE)):
            n = batch.num_rows
            hashes, sizes = _tokens(batch.column(1))
            owner = np.repeat(np.arange(n), sizes)
            ids = automaton.words.find(hashes)
            unknown = np.flatnonzero(ids < 0)
            totals, taken = automaton.read(ids, sizes, order)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)),
                    batch.column(0),
                    pa.array(sizes),
                    pa.array(np.bincount(owner[ids >= 0], minlength=n)),
                    pa.array(np.bincount(owner, alone[ids], n)),
                    pa.array(totals, pa.float64()),
                    _bytes(hashes[unknown], owner[unknown], n),
                    others(taken, owner, sizes, hashes),
                ],
                names=["row", "doc_id", "n_tokens", "known", "base", "walk", "rare", "keys"],
            )
            row += n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    schema = (
        "row long, doc_id long, n_tokens long, known long, base double, walk double, "
        "rare binary, keys array<binary>"
    )
    walked = written(rows.mapInArrow(run, schema), "walked")
    _give_back(docs.sparkSession)
    none = F.lit(0.0)
    costs = model.counts.select(F.col("a").alias("key"), "cost", none.alias("back")).union(model.word_backs.select("a", none, "back"))
    rare = _looked_up(walked.select("row", F.col("rare").alias("keys")), costs)
    rare = written(rare, "rare")
    _give_back(docs.sparkSession)
    weighed = _weighed(walked, model.weights)
    parts = rare.union(weighed.select("row", F.lit(0).cast("long"), none, "weight"))
    more = parts.groupBy("row").agg(F.sum("hits").alias("hits"), F.sum("cost").alias("more"), F.sum("back").alias("more_walk"))
    done = walked.drop("rare", "keys").join(more, "row", "left")
    known = F.col("known") + F.coalesce("hits", F.lit(0))
    rest = F.coalesce("more", none) + (F.col("n_tokens") - known) * F.lit(unseen)
    return done.select(
        "doc_id",
        "n_tokens",
        known.alias("n_known"),
        (F.col("base") + rest).alias("base_score"),
        (F.col("walk") + rest + F.coalesce("more_walk", none)).alias("score"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    model = LanguageModel(docs.where(~held_out).select(text_or_empty().alias("text")))
    return score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
