"""Piece encoding by backtracking against the library and against merges by definition."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tests.conftest import SF_DIR
from tripmill.llm import pieces
from tripmill.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return pieces.PieceModel(file.read())


@pytest.fixture(scope="module")
def encoder(model):
    return pieces.PieceEncoder(model)


def ids_of(encode, text):
    packed = encode(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@pytest.mark.parametrize(
    "letters", ["ab ", "  aeinrst", "▁ e\n", "the in on er  ", "\U0001f600é日本 a", "0123 .,", "<0x>s/▁ ", "\x00\t  x"]
)
def test_random_texts_equal_the_library(model, encoder, letters):
    rng = random.Random(letters)
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randint(0, 40)))
        wanted = model.library.encode(text)
        assert ids_of(encoder, text) == wanted
        assert pieces.decoded(model, [1, *wanted, 2]) == model.library.decode([1, *wanted, 2])


def test_texts_of_pieces_equal_the_library(model, encoder):
    rng = random.Random(7)
    every = list(model.id_of)
    for _ in range(3000):
        text = "".join(rng.choices(every, k=rng.randint(1, 8))).replace("▁", " ")
        assert ids_of(encoder, text) == model.library.encode(text)


def test_long_stretches_and_windows(model, monkeypatch):
    rng = random.Random(1)
    texts = ["x" * 30_000, "ab" * 20_000, " " * 5000, "".join(rng.choices("aeinrst", k=9000)), "é" * 3000]
    for window in (1, 7, pieces.WINDOW):
        monkeypatch.setattr(pieces, "WINDOW", window)
        encoder = pieces.PieceEncoder(model)
        for text in texts if window > 1 else [t[:500] for t in texts]:
            assert ids_of(encoder, text) == model.library.encode(text)


def test_backtracking_equals_merges_by_definition(model):
    """On a model of few letters, where long matches often have to give way."""
    rng = random.Random(5)
    for _ in range(30):
        small = object.__new__(pieces.PieceModel)
        ranked = list(dict.fromkeys(["a", "b", "▁", *("".join(rng.choices("ab▁", k=rng.randint(2, 5))) for _ in range(20))]))
        small.id_of = {p: i for i, p in enumerate(ranked)}
        small.rank = {p: float(i) for i, p in enumerate(ranked)}
        small.beside = {pair for p in ranked for pair in zip(p, p[1:], strict=False)}
        # Pieces that merges cannot make from smaller ones of better score are no pieces of a trained model.
        made = {p for p in ranked if len(p) == 1}
        for p in ranked:
            if any(p[:i] in made and p[i:] in made for i in range(1, len(p))):
                made.add(p)
        small.id_of = {p: i for p, i in small.id_of.items() if p in made}
        small.rank = {p: r for p, r in small.rank.items() if p in made}
        encoder = pieces.PieceEncoder(small)
        for _ in range(200):
            text = "".join(rng.choices("ab▁", k=rng.randint(1, 30)))
            assert encoder.pieces(text) == small.merged(text)


def test_ids_that_make_no_character(model):
    for ids in ([3 + 0xC3], [3 + 0xC3, 3 + 0x41], [1, 3 + 0xE3, 3 + 0x81, 2], [0], []):
        assert pieces.decoded(model, ids) == model.library.decode(ids)


def test_other_models_are_refused(model):
    with pytest.raises(ValueError, match="merge-type"):
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        with open(PATH, "rb") as file:
            other = ModelProto.FromString(file.read())
        other.trainer_spec.model_type = 1
        pieces.PieceModel(other.SerializeToString())


def digests(library, text):
    ids = [library.bos_id(), *library.encode(text), library.eos_id()]
    packed = struct.pack(f"<{len(ids)}I", *ids)
    decoded = library.decode(ids).encode("utf-8")
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()


def test_query_equals_the_library_on_the_given_table(spark):
    library = SentencePieceProcessor(model_file=PATH)
    wanted = {r.doc_id: digests(library, r.text or "") for r in table(spark, SF_DIR, "documents").collect()}
    got = pieces.op11_piece_backtracking(spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == wanted and len(got) == len(wanted)


def test_odd_rows(spark, documents, odd_rows):
    library = SentencePieceProcessor(model_file=PATH)
    done = pieces.decode_pieces(pieces.encode_pieces(documents(odd_rows), PATH), PATH)
    got = sorted(((r.doc_id, len(r.ids) // 4, r.text) for r in done.collect()), key=str)
    wanted = []
    for doc_id, text, _ in odd_rows:
        ids = [1, *library.encode(text or ""), 2]
        wanted.append((doc_id, len(ids), library.decode(ids)))
    assert got == sorted(wanted, key=str)
    assert pieces.decode_pieces(pieces.encode_pieces(documents([]), PATH), PATH).count() == 0
