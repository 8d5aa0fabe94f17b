from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tripmill.llm import scoring


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_tokens_are_hashed_in_bulk_as_words_of_has_them(kind):
    texts = ["cut off", "", " \t\n", "A b  C\x0bd\x0ce\x1cf\x85g ß Ä", "x" * 5000 + " y", " lead trail ", "ABCDEFGH abcdefghi", "q", "r"]
    texts = pa.array(texts, kind).slice(1)
    flat, sizes = scoring._tokens(texts)
    words = [scoring.words_of(t) for t in texts.to_pylist()]
    assert sizes.tolist() == [len(w) for w in words]
    hashes = {}
    for digest, word in zip(flat.tolist(), [w for ws in words for w in ws], strict=True):
        assert hashes.setdefault(word, digest) == digest
    assert len(set(hashes.values())) == len(hashes) and hashes[b""] == scoring.END_HASH


def test_sorting_by_high_bits_is_sorting():
    rng = np.random.default_rng(0)
    for keys in (rng.integers(0, 2**63, 5000), rng.integers(0, 50, 5000), np.zeros(0)):
        keys = keys.astype(np.uint64)
        order = scoring._order(keys)
        assert sorted(order.tolist()) == [*range(len(keys))] and (keys[order] == np.sort(keys)).all()


def test_rows_come_back_from_their_parts():
    edges = scoring._edges(5)
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 300, dtype=np.uint64))
    n, weights = np.arange(300), np.linspace(-3, 3, 300)
    found = [scoring._taken(part, packed, edges) for part, packed in scoring._dealt(keys, edges, n, weights.view(np.uint64))]
    assert len(found) == 5
    back = [np.concatenate(c) for c in zip(*found, strict=True)]
    assert (back[0] == keys).all() and (back[1] == n).all() and (back[2].view(np.float64) == weights).all()


def test_ngrams_are_dealt_in_packed_rows(spark):
    """op8 deals n-grams as a row for each part of a task, not as a row for each n-gram, and counts all of them."""
    texts = [" ".join(f"w{i * j % 11}" for j in range(60)) + f" once{i} more" for i in range(40)]
    words = [scoring.words_of(t) for t in texts]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    bits = spark.sparkContext.broadcast(np.full(scoring.FILTER_BITS >> 6, -1, dtype=np.int64))
    parts = scoring.gram_counts(rows, bits, 2, 3).collect()
    pairs = Counter(p for ws in words for p in zip(ws, ws[1:], strict=False))
    packed = [r for r in parts if r.part is not None]
    assert len(packed) == 3 < len(pairs)
    edges = scoring._edges(3)
    n = [x for r in packed for x in scoring._taken(r.part, bytes(r.grams), edges)[2].tolist()]
    assert sorted(n) == sorted(x for x in pairs.values() if x > 1)
    assert sum(r.once or 0 for r in parts) == sum(x == 1 for x in pairs.values())
    assert sum(r.twice or 0 for r in parts) == sum(x == 2 for x in pairs.values())
