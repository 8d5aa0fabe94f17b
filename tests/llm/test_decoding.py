"""Decoding of the BPE lexicon: all ids of a batch at once, with the library's result."""

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from tripmill.llm import lexicon

SPACE_FIRST = public_tokenizers.path("byte_bpe_50k.json")


class _NoLookups(list):
    def __getitem__(self, place):
        raise AssertionError("ids are looked up one by one in Python")


def test_decoding_takes_all_ids_at_once():
    with open(SPACE_FIRST, encoding="utf-8") as file:
        vocabulary = lexicon.Vocabulary(file.read())
    library = Tokenizer.from_file(SPACE_FIRST)
    texts = ["", "a b  c", "é 日本語 \U0001f600 <|endoftext|>", "x" * 500 + " y"]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    emoji = library.encode("\U0001f600", add_special_tokens=False).ids
    ids += [emoji[:1], [], None]  # a text ending inside a character, an empty one, and no ids
    vocabulary.bytes_of = _NoLookups(vocabulary.bytes_of)
    got = lexicon._decoded(vocabulary, pa.array(ids, pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(i or [], skip_special_tokens=False) for i in ids[:-1]] + [""]
    assert got[-3] == "�"
