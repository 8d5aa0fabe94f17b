"""Byte-level BPE encoding with a lexicon of frequent words, and decoding.

The lexicon is a minimal acyclic transducer: an automaton over the bytes of words in which equal suffixes share
their states, and whose arcs carry numbers that add up to a word's place in the list of outputs, the word's
token ids. It is compiled from word counts over all texts, laid out as flat arrays in one file in the shared
folder, handed to the executors by Spark and memory-mapped there, so the workers of a machine share one copy.
All different words of a batch walk it in step. Words that it lacks are merged by the tokenizer's own merge
ranks, so the lexicon's size decides speed only, never a result.

NULL text is empty and has no ids. Strings of special tokens in a text are those tokens. Repeated rows stay;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmill.llm.common import frequent, mapped, shared_file, slices, table, text_or_empty, to_file, written
from tripmill.llm.tokens import PLAIN_BELOW, SPACE_FIRST_PATTERN, byte_letters, split_parts

#: Most words the lexicon takes; the rest are merged.
LEXICON_WORDS = 1 << 16
_FLUSH = 200_000
#: Bytes of text, or ids, that a task takes apart at a time.
_SLICE = 1 << 21


class Vocabulary:
    """Byte-level BPE by definition: words of a text, their exact merges, and bytes of ids."""

    def __init__(self, definition: str) -> None:
        self.library = Tokenizer.from_str(definition)
        model = json.loads(definition)["model"]
        numbers = model["vocab"]
        self.letters = letters = byte_letters()
        back = {letter: byte for byte, letter in enumerate(letters)}
        self.byte_ids = [numbers.get(letter, -1) for letter in letters]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[numbers[left], numbers[right]] = (rank, numbers[left + right])
        added = self.library.get_added_tokens_decoder()
        self.special = {token.content: number for number, token in added.items()}
        size = max([*numbers.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, number in numbers.items():
            self.bytes_of[number] = bytes(back[c] for c in token)
        for content, number in self.special.items():
            self.bytes_of[number] = content.encode("utf-8")
        #: The bytes of each id as an Arrow array, for decoding many ids at once.
        self.byte_strings = pa.array(self.bytes_of, pa.large_binary())
        strings = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(strings)})").split if strings else lambda text: [text]
        self.find = regex.compile(SPACE_FIRST_PATTERN).findall

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, in order."""
        if text.isascii() or max(text) < PLAIN_BELOW:
            return self.find(text)
        # Where Unicode versions may differ the library says where words end.
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def words_in(self, lead: str, part: str) -> list[str]:
        """The words of a part of a text after ``lead``; letters of ASCII are one word."""
        return [lead + part] if part.isascii() and part.isalpha() else self.words(lead + part)

    def pieces(self, text: str) -> list[str]:
        """A text cut at strings of special tokens, which are pieces as well; no empty ones."""
        return list(filter(None, self.cut(text) if any(s in text for s in self.special) else [text]))

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the pair of lowest rank is joined first, the leftmost of equal ones."""
        ids = [self.byte_ids[b] for b in word]
        last = len(ids) - 1
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, last))
        heap = [(*self.ranks[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, joined, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j > last or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = joined, -1
            after[i] = after[j]
            if after[i] <= last:
                before[after[i]] = i
                pair = (joined, ids[after[i]])
                if pair in self.ranks:
                    heapq.heappush(heap, (*self.ranks[pair], i, *pair))
            if before[i] >= 0:
                pair = (ids[before[i]], joined)
                if pair in self.ranks:
                    heapq.heappush(heap, (*self.ranks[pair], before[i], *pair))
        return [i for i in ids if i >= 0]

    def merge_unseen(self, word: bytes) -> list[int]:
        """The same by the library's merges alone, a word at a time: cheaper for the many words met once."""
        return [token.id for token in self.library.model.tokenize("".join([self.letters[b] for b in word]))]


def compile_lexicon(words: list[bytes], outputs: list[list[int]]) -> dict[str, np.ndarray]:
    """Flat arrays of the minimal automaton of ``words`` (sorted, distinct) with the ids of each.

    Built word by word: when a word leaves the path of the one before, the states left behind are
    final and are replaced by equal ones met earlier.
    """
    finals: list[int] = []  # 1 if a word ends in the state
    arcs: list[tuple] = []  # (byte, state) pairs of the state
    below: list[int] = []  # words that end in the state or beyond
    known: dict[tuple, int] = {}

    def state_of(final: int, out: list[tuple[int, int]]) -> int:
        key = (final, tuple(out))
        if key not in known:
            known[key] = len(finals)
            finals.append(final)
            arcs.append(key[1])
            below.append(final + sum(below[s] for _, s in out))
        return known[key]

    path: list[list] = [[0, []]]  # open states along the last word: final, arcs
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, out = path.pop()
            path[-1][1].append((last[len(path) - 1], state_of(final, out)))

    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        path.extend([0, []] for _ in word[shared:])
        path[-1][0] = 1
        last = word
    close(0)
    root = state_of(*path[0])
    keys, targets, numbers = [], [], []
    for state, out in enumerate(arcs):
        number = finals[state]
        for byte, target in out:
            keys.append(state << 8 | byte)
            targets.append(target)
            numbers.append(number)  # words that come before those along this arc
            number += below[target]
    sizes = np.array([len(ids) for ids in outputs], dtype=np.int64)
    return {
        "root": np.array([root], dtype=np.int64),
        "final": np.array(finals, dtype=np.int64),
        "key": np.array(keys, dtype=np.int64),
        "target": np.array(targets, dtype=np.int64),
        "number": np.array(numbers, dtype=np.int64),
        "ends": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        "ids": np.array([i for ids in outputs for i in ids], dtype=np.int64),
    }


class Lexicon:
    """A memory-mapped lexicon file."""

    def __init__(self, path: str) -> None:
        self.arrays = mapped(path)

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the outputs, -1 for words that the lexicon lacks. All words walk in step."""
        a = self.arrays
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        result = np.full(len(words), -1, dtype=np.int64)
        if not len(a["key"]):
            return result
        alive = np.flatnonzero(sizes > 0)
        state = np.full(len(alive), a["root"][0])
        number = np.zeros(len(alive), dtype=np.int64)
        step = 0
        while len(alive):
            key = state << 8 | flat[begins[alive] + step]
            arc = np.minimum(np.searchsorted(a["key"], key), len(a["key"]) - 1)
            there = a["key"][arc] == key
            alive, arc = alive[there], arc[there]
            state, number = a["target"][arc], number[there] + a["number"][arc]
            step += 1
            ended = sizes[alive] == step
            done = ended & (a["final"][state] == 1)
            result[alive[done]] = number[done]
            alive, state, number = alive[~ended], state[~ended], number[~ended]
        return result

    def output(self, place: int) -> list[int]:
        ends = self.arrays["ends"]
        return self.arrays["ids"][ends[place] : ends[place + 1]].tolist()


_VOCABULARIES: dict[str, Vocabulary] = {}
_LEXICONS: dict[str, Lexicon] = {}


def vocabulary_maker(spark: SparkSession, path: str) -> Callable[[], Vocabulary]:
    """For use in tasks; the definition has a few megabytes whatever the input."""
    with open(path, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())

    def make() -> Vocabulary:
        if path not in _VOCABULARIES:
            _VOCABULARIES[path] = Vocabulary(sent.value)
        return _VOCABULARIES[path]

    return make


def word_counts(docs: DataFrame, make: Callable[[], Vocabulary]) -> DataFrame:
    """(word, n) over all texts, summed in the task before the shuffle."""

    def rows(heads: Counter, tails: Counter) -> pa.RecordBatch:
        words_in, counts = make().words_in, Counter()
        for lead, parts in (("", heads), (" ", tails)):
            for part, n in parts.items():
                for word in words_in(lead, part):
                    counts[word] += n
        return pa.RecordBatch.from_arrays(
            [pa.array([w.encode("utf-8") for w in counts], pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No word reaches over a space between two others: parts are counted, and cut into words once.
        vocabulary, heads, tails = make(), Counter(), Counter()
        for batch in batches:
            for text in batch.column(0):
                for piece in vocabulary.pieces(text.as_py()):
                    if piece not in vocabulary.special:
                        first, *later = split_parts(piece)
                        heads[first] += 1
                        tails.update(later)
                if len(heads) + len(tails) > _FLUSH:
                    yield rows(heads, tails)
                    heads, tails = Counter(), Counter()
        yield rows(heads, tails)

    return (
        docs.select(text_or_empty().alias("text"))
        .mapInArrow(count, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def build_lexicon(docs: DataFrame, path: str, most: int = LEXICON_WORDS) -> str:
    """Count words of all texts, compile the frequent ones, hand the file out; its name."""
    spark = docs.sparkSession
    counts = word_counts(docs, vocabulary_maker(spark, path)).where("n > 1")
    frequent_words = frequent(written(counts, "word-counts"), most)
    words = sorted(bytes(row.word) for row in frequent_words.select("word").collect())
    with open(path, encoding="utf-8") as file:
        vocabulary = Vocabulary(file.read())
    return shared_file(spark, to_file(compile_lexicon(words, [vocabulary.merge(w) for w in words])), "lexicon")


class _TextEncoder:
    """Ids of texts: their parts' words walk the lexicon together, those that it lacks are merged.

    Parts met lately are remembered by themselves, in two generations of ``_FLUSH``; those behind a space apart from
    those that begin a text, by their text without that space.
    """

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.special = {string: struct.pack("<i", i) for string, i in vocabulary.special.items()}
        self.known: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.aside: dict[str, dict[str, bytes]] = {"": {}, " ": {}}

    def _learn(self, lead: str, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts that are not known, each after ``lead``; they are known from then on, but for long ones."""
        known, aside = self.known[lead], self.aside[lead]
        if len(known) > _FLUSH:
            self.aside[lead], self.known[lead] = known, {}
            known, aside = self.known[lead], known
        found = {p: aside[p] for p in parts if p in aside}
        new = [p for p in parts if p not in found]
        words = [self.vocabulary.words_in(lead, p) for p in new]
        different = list(set().union(*words))
        coded = [w.encode("utf-8") for w in different]
        ids = {}
        for word, code, place in zip(different, coded, self.lexicon.places(coded).tolist(), strict=True):
            merged = self.vocabulary.merge_unseen(code) if place < 0 else self.lexicon.output(place)
            ids[word] = struct.pack(f"<{len(merged)}i", *merged)
        for part, own in zip(new, words, strict=True):
            found[part] = b"".join([ids[w] for w in own])
        known.update((p, i) for p, i in found.items() if len(p) < 200)
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers."""
        first, later = self.known[""].get, self.known[" "].get
        rows = []  # of a text, piece by piece: parts and their ids as far as they are known; or a special token's ids
        lacking: dict[str, set[str]] = {"": set(), " ": set()}
        for text in texts:
            row: list = []
            for string in self.vocabulary.pieces(text):
                if string in self.special:
                    row.append((None, [self.special[string]]))
                    continue
                parts = split_parts(string)
                found = [first(parts[0]), *map(later, parts[1:])]
                if found[0] is None:
                    lacking[""].add(parts[0])
                if None in found:
                    lacking[" "].update([p for p, ids in zip(parts[1:], found[1:], strict=True) if ids is None])
                    row.append((parts, found))
                else:
                    row.append((None, found))
            rows.append(row)
        more = {lead: self._learn(lead, parts) if parts else {} for lead, parts in lacking.items()}
        starts, follows = more[""], more[" "]
        out = []
        for row in rows:
            for parts, found in row:
                if parts is not None:
                    at = -1
                    for _ in range(found.count(None)):
                        at = found.index(None, at + 1)
                        found[at] = follows[parts[at]] if at else starts[parts[0]]
            out.append(b"".join([ids for _, found in row for ids in found]))
        return out


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int64)
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _decoded(vocabulary: Vocabulary, ids: pa.ListArray) -> pa.StringArray:
    """The text of each list of ids: the bytes of all ids are taken at once, and the texts cut from them."""
    values, ends = ids.flatten().to_numpy(zero_copy_only=False), np.diff(ids.offsets.to_numpy()).cumsum()
    values = np.where(values < 0, values + len(vocabulary.bytes_of), values)  # as a list's index would be
    taken = vocabulary.byte_strings.take(pa.array(values, pa.int64()))
    offsets = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)
    bounds = offsets[np.concatenate([[0], ends]).astype(np.int64)]
    data = taken.buffers()[2] or pa.py_buffer(b"")
    texts = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.array(bounds, pa.int64()).buffers()[1], data])
    try:
        return texts.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:  # some bytes are no UTF-8, as where a text ends inside a character
        return pa.array([b.decode("utf-8", "replace") for b in texts.to_pylist()], pa.string())


def _encoder(make: Callable[[], Vocabulary], lexicon: str) -> _TextEncoder:
    if lexicon not in _LEXICONS:
        _LEXICONS[lexicon] = Lexicon(SparkFiles.get(lexicon))
    return _TextEncoder(make(), _LEXICONS[lexicon])


def encode_texts(docs: DataFrame, path: str, lexicon: str, decode: bool = False) -> DataFrame:
    """(doc_id, ids) of every text; with ``decode`` also ``text``, what the ids stand for."""
    make = vocabulary_maker(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(make, lexicon)
        for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
            ids = _lists(encode([text.as_py() for text in batch.column(1)]))
            columns = {"doc_id": batch.column(0), "ids": ids}
            if decode:
                columns["text"] = _decoded(encode.vocabulary, ids)
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>" + (", text string" if decode else ""))


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text that the ids stand for, special tokens included."""
    make = vocabulary_maker(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
            ids = batch.column(1)
            columns = {"doc_id": batch.column(0), "ids": ids, "text": _decoded(make(), ids)}
            yield pa.RecordBatch.from_pydict(columns)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def op7_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = encode_texts(docs, path, build_lexicon(docs, path), decode=True)
    decimals = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimals, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
