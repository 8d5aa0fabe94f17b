"""Token files, packing and the BPE lexicon against the library itself."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmill.llm import lexicon, packing, token_files
from tripmill.llm.common import shared_path
from tripmill.llm.tokens import TextEncoder

WORD_END = public_tokenizers.path("word_bpe_49k.json")
SPACE_FIRST = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "",
    "  a  b\n\n c \t d",
    "don't it's I'LL x'",
    "é é ﬁ ǅ İstanbul ΑΣ Σ",
    "a\x1cb a\x1c!b \x1c",
    "<|endoftext|> x <|startoftext|>a<|end",
    "日本語 テスト 12345 ١٢ ½",
    "\xa0a \xa0 b c",
    "x" * 3000 + " y",
    "tail ",
    "\n",
    " \U0001f600",
]


def random_texts(n):
    rng = random.Random(1)
    letters = " \n\t\x1c\xa0'sSt<|aÉé́İΣ1½.!日"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("path,kind", [(WORD_END, "word_end"), (SPACE_FIRST, "space_first"), (SPACE_FIRST, None)])
def test_encoder_equals_library(path, kind):
    with open(path, encoding="utf-8") as file:
        encode = TextEncoder(file.read(), kind)
    library = Tokenizer.from_file(path)
    for text in [*ODD, *random_texts(3000)]:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_code_lengths_are_limited_and_best():
    rng = np.random.default_rng(3)
    counts = (2.0 ** rng.uniform(0, 40, 300)).astype(np.int64)
    counts[:5] = 0
    lengths = token_files.code_lengths(counts, 12)
    used = lengths[lengths > 0]
    assert len(used) == 295 and used.max() <= 12 and sum(2.0**-used) == 1
    # Without a tight limit the code is as good as Huffman's.
    import heapq

    small = counts[counts > 0][:40] % 1000 + 1
    heap, cost = small.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert (token_files.code_lengths(small, 30) * small).sum() == cost


@pytest.mark.parametrize("n", [0, 1, 5, 5000])
def test_bits_round_trip_from_any_checkpoint(n):
    ids = np.random.default_rng(n).geometric(0.05, n).astype(np.int64)
    lengths = token_files.code_lengths(np.bincount(ids, minlength=3))
    entries, longest = token_files.decoding_table(lengths)
    payload, starts = token_files.encode_bits(ids, lengths, token_files.canonical_codes(lengths))
    data = np.frombuffer(payload, np.uint8)
    marks = starts[::100]
    counts = np.minimum(100, n - np.arange(len(marks)) * 100)
    assert token_files.decode_bits(data, marks, counts, entries, longest).tolist() == ids.tolist()
    if n > 1000:
        one = token_files.decode_bits(data, marks[7:8], counts[7:8], entries, longest)
        assert one.tolist() == ids[700:800].tolist()


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


def test_token_files(spark, documents, odd_rows):
    library = Tokenizer.from_file(WORD_END)
    folder = shared_path(spark, "files")
    token_files.write_token_files(documents(odd_rows), folder, WORD_END, "word_end", 2, block_tokens=64)
    got = [
        (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist())
        for r in token_files.read_token_files(spark, folder).orderBy("start").collect()
    ]
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in odd_rows]
    assert sorted(Counter((i, tuple(x)) for i, _, x in got).items(), key=str) == sorted(
        Counter((i, tuple(x)) for i, x in ids).items(), key=str
    )
    assert [i for i, _, _ in got] == sorted((i for i, _ in ids), key=lambda i: (i is not None, i or 0))
    assert [s for _, s, _ in got] == np.cumsum([0, *(len(x) for _, _, x in got)])[:-1].tolist()


def test_token_files_of_nothing(spark, documents):
    folder = shared_path(spark, "files")
    token_files.write_token_files(documents([]), folder, WORD_END, "word_end", 2)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_fullest_bin_is_the_best_sum():
    rng = random.Random(5)
    for _ in range(200):
        counts = Counter(rng.randint(1, 30) for _ in range(rng.randint(1, 12)))
        found = packing.fullest(dict(counts), 40)
        assert all(counts[n] >= k for n, k in found.items()) and max(counts) in found
        sums = {max(counts)}
        rest = (counts - Counter([max(counts)])).elements()
        for n in rest:
            sums |= {s + n for s in sums if s + n <= 40}
        assert sum(n * k for n, k in found.items()) == max(sums)


def check_packing(rows, texts, capacity):
    library = Tokenizer.from_file(SPACE_FIRST)
    got = Counter()
    pieces = sorted(rows, key=lambda r: (str(r.doc_id), r.start, r.ids))
    for r in pieces:
        assert r.length == len(r.ids) // 4 <= capacity
        got[r.doc_id] += r.length
    wanted = Counter()
    for i, t, _ in texts:
        wanted[i] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    assert got == wanted
    bins = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert bins.get(r.sequence_id, 0) == r.offset
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values(), default=0) <= capacity
    return len(bins)


def test_packing(documents, odd_rows):
    rows = packing.pack(documents(odd_rows), SPACE_FIRST, "space_first", 2, capacity=64).collect()
    used = check_packing(rows, odd_rows, 64)
    assert used <= -(-sum(r.length for r in rows) // 64) + 1
    library = Tokenizer.from_file(SPACE_FIRST)
    long_ids = library.encode(odd_rows[5][1], add_special_tokens=False).ids + [2]
    mine = sorted((r for r in rows if r.doc_id == 5), key=lambda r: r.piece)
    assert np.frombuffer(b"".join(r.ids for r in mine), "<u4").tolist() == long_ids
    assert [r.piece for r in mine] == list(range(len(mine))) and all(r.length == 64 for r in mine[1:])
    assert packing.pack(documents([]), SPACE_FIRST, "space_first", 2).count() == 0


def test_automaton_is_minimal_and_exact():
    words = sorted({w.encode() for w in ("walking", "talking", "walked", "talked", "walk", "talk", "king", "a", "ab", "é")})
    outputs = [[n, n + 1] for n in range(len(words))]
    arrays = lexicon.compile_lexicon(words, outputs)
    known = lexicon.Lexicon.__new__(lexicon.Lexicon)
    known.arrays = arrays
    assert known.places(words).tolist() == list(range(len(words)))
    assert known.places([b"", b"wal", b"walke", b"walkedx", b"zzz"]).tolist() == [-1] * 5
    assert [known.output(i) for i in range(len(words))] == outputs
    # Suffixes are shared: a trie of these words has more states.
    assert len(arrays["final"]) < len({w[:k] for w in words for k in range(len(w) + 1)})


@pytest.mark.parametrize("most", [0, 4, 1 << 16])
def test_lexicon_changes_no_id(spark, documents, odd_rows, most):
    rows = [*odd_rows, *((100 + n, t, "en") for n, t in enumerate([*ODD, *random_texts(200)]))]
    library = Tokenizer.from_file(SPACE_FIRST)
    docs = documents(rows)
    coded = lexicon.encode_texts(docs, SPACE_FIRST, lexicon.build_lexicon(docs, SPACE_FIRST, most))
    got = lexicon.decode_ids(coded, SPACE_FIRST).collect()
    wanted = Counter()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in got) == wanted
    none = documents([])
    assert lexicon.encode_texts(none, SPACE_FIRST, lexicon.build_lexicon(none, SPACE_FIRST)).count() == 0


def test_queries_on_given_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(WORD_END)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    start, wanted = 0, set()
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [2]
        wanted.add((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in token_files.op1_token_files(spark, sf_dir).collect()} == wanted
