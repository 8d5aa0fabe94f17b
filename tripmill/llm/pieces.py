"""Exact piece encoding for merge-type models by backtracking, and decoding.

A merge-type model joins the two adjacent pieces whose union has the best score, the leftmost of equals, until
no union is a piece. Its result is the one way to write a text as pieces in which any two neighbours come out
again when the text of the two is merged anew. So no merge need be replayed over the text: the longest piece at
a place is taken (all pieces that match are found by one Aho-Corasick pass), it must fit the piece before it,
which re-merging the two decides, and a shorter one is tried if it does not. Where none fits, the place is
marked in a bit field of failed positions and the piece before gives way.

A text is taken apart where no piece has the two characters side by side, in particular before a space that follows
another character; merges never reach over such a place, so parts are encoded on their own and remembered.
A character that is no piece becomes the pieces of its bytes.

NULL text is empty: it has the begin and end ids only and decodes to the empty string. Texts of any length are
encoded whole: matches are held for a window of ``WINDOW`` characters, besides the bit field and the result.
Rows that repeat stay, and NULL doc_ids stay NULL. An empty table gives an empty result; further columns are ignored,
whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece.sentencepiece_model_pb2 import ModelProto

from tripmill.llm.common import slices, table, text_or_empty
from tripmill.llm.tokens import Filled

SPACE = "▁"
#: Characters whose matches are held at a time.
WINDOW = 1 << 12
#: Entries of each table of results met lately (twice as many at most).
_REMEMBERED = 200_000
#: Bytes of text, or of ids, that a task takes apart at a time.
_SLICE = 1 << 21
_RUNS = regex.compile(r" +[^ ]*").findall

# Kinds of models and pieces in the model file.
_MERGE_MODEL = 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class PieceModel:
    """The pieces of a merge-type model file."""

    def __init__(self, data: bytes) -> None:
        model = ModelProto.FromString(data)
        normal = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        plain = normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
        if model.trainer_spec.model_type != _MERGE_MODEL or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("not a merge-type model, or one with user-defined or unused pieces")
        if not plain or normal.precompiled_charsmap or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a model that changes texts before it encodes them")
        self.library = SentencePieceProcessor(model_proto=data)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == _NORMAL}
        unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        byte_ids = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.byte_ids = [byte_ids.get(b, unknown) for b in range(256)]
        self.beside = {pair for piece in self.id_of for pair in zip(piece, piece[1:], strict=False)}
        self.bytes_of: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                self.bytes_of.append(bytes([int(p.piece[3:-1], 16)]))
            elif p.type == _UNKNOWN:
                self.bytes_of.append(model.trainer_spec.unk_surface.encode("utf-8"))
            else:
                self.bytes_of.append(b"" if p.type == _CONTROL else p.piece.replace(SPACE, " ").encode("utf-8"))
        self.control = {i for i, p in enumerate(model.pieces) if p.type == _CONTROL}
        self.spaced = {i for piece, i in self.id_of.items() if piece.startswith(SPACE)}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by definition, one merge after the other."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            unions = [rank.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            found = [(r, i) for i, r in enumerate(unions) if r is not None]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, without begin and end."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.automaton = ahocorasick.Automaton()
        # Pieces that come out of their own merges, and their characters, which may be no pieces.
        self.whole = {piece for piece in model.id_of if model.merged(piece) == [piece]}.union(*model.id_of)
        for piece in self.whole:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.longest = max(map(len, self.whole), default=1)
        #: For each piece the longest shorter one that it begins with.
        self.shorter: dict[str, str | None] = {}
        for piece in self.whole:
            heads = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self.shorter[piece] = next((head for head in heads if head in self.whole), None)
        self.packed = Filled(self._packed, _REMEMBERED)
        # Whether a text can be cut before every space that follows another character.
        self.cut_at_spaces = not any(a != SPACE and b == SPACE for a, b in model.beside)
        self.fits = Filled(lambda pair: model.merged(pair[0] + pair[1]) == [*pair], _REMEMBERED)
        self.stretches = Filled(self._stretch, _REMEMBERED)
        self.parts = Filled(lambda part: self._part(SPACE + part), _REMEMBERED)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        plain = text.replace(SPACE, " ")
        if not self.cut_at_spaces:
            return self._part((" " + plain).replace(" ", SPACE))
        parts = plain.split(" ")
        if "" not in parts:
            return b"".join(map(self.parts.__getitem__, parts))
        runs = _RUNS(" " + plain)
        return b"".join([self.parts[r[1:]] if r[1:2] != " " else self._part(r.replace(" ", SPACE)) for r in runs])

    def _part(self, part: str) -> bytes:
        """A part cut where no piece has the two characters side by side."""
        beside, stretches = self.model.beside, self.stretches
        cuts = [i for i, pair in enumerate(zip(part, part[1:], strict=False), 1) if pair not in beside]
        if not cuts:
            return self._stretch(part)
        first = self.parts[part[1 : cuts[0]]] if part[0] == SPACE else stretches[part[: cuts[0]]]
        return first + b"".join([stretches[part[a:b]] for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True)])

    def _packed(self, piece: str) -> bytes:
        number = self.model.id_of.get(piece)
        ids = [number] if number is not None else [self.model.byte_ids[b] for b in piece.encode("utf-8")]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stretch(self, text: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.pieces(text)))

    def _longest(self, text: str, start: int) -> list[int]:
        """For each place of a window, the length of the longest piece that begins there."""
        if len(text) <= WINDOW:
            found = [1] * len(text)
            for end, length in self.automaton.iter(text):  # by their ends, so the longest comes last
                found[end + 1 - length] = length
            return found
        stop = min(start + WINDOW, len(text))
        found = [1] * (stop - start + self.longest)
        for end, length in self.automaton.iter(text[start : stop + self.longest - 1]):
            found[end + 1 - length] = length
        return found[: stop - start]

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text that is one character or has characters of pieces only."""
        if text in self.whole or len(text) == 1:
            return [text]
        fits, shorter, taken = self.fits, self.shorter, []
        failed, any_failed = bytearray((len(text) >> 3) + 1), False
        windows: dict[int, list[int]] = {}
        window, base, at, size = self._longest(text, 0), 0, 0, len(text)
        windows[0] = window
        before = None
        piece: str | None = text[: window[0]]
        while True:
            # ``piece`` is the longest one at ``at`` that has not been tried after ``before``.
            while piece is not None:
                end = at + len(piece)
                open_ = not any_failed or not failed[end >> 3] >> (end & 7) & 1
                if open_ and (before is None or fits[before, piece]):
                    break
                piece = shorter[piece]
            else:
                if before is None:
                    raise RuntimeError("pieces that no merges lead to")
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                piece = taken.pop()
                at -= len(piece)
                before = taken[-1] if taken else None
                piece = shorter[piece]
                continue
            taken.append(piece)
            before, at = piece, end
            if at == size:
                return taken
            if not base <= at < base + len(window):
                base = at // WINDOW * WINDOW
                if base not in windows:
                    if len(windows) > 1:
                        windows.clear()
                    windows[base] = self._longest(text, base)
                window = windows[base]
            piece = text[at : at + window[at - base]]


def decoded(model: PieceModel, ids: list[int]) -> str:
    """The text that ``ids`` stand for; the space before the first piece goes."""
    data = b"".join(map(model.bytes_of.__getitem__, ids))
    first = next((i for i in ids if i not in model.control), None)
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:  # byte pieces that make no character
        return model.library.decode(ids)
    return text[1:] if first in model.spaced else text


_MODELS: dict[str, PieceModel] = {}
_ENCODERS: dict[str, PieceEncoder] = {}


def model_maker(spark: SparkSession, path: str) -> Callable[[], PieceModel]:
    """For use in tasks: the model of the driver's file, one per worker process; a file of a megabyte, whatever the input."""
    with open(path, "rb") as file:
        data = file.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path} is too large to broadcast")
    sent = spark.sparkContext.broadcast(data)

    def make() -> PieceModel:
        if path not in _MODELS:
            _MODELS[path] = PieceModel(sent.value)
        return _MODELS[path]

    return make


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every text: with begin and end, as little-endian unsigned 32-bit integers."""
    make = model_maker(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        if path not in _ENCODERS:
            _ENCODERS[path] = PieceEncoder(model)
        encode = _ENCODERS[path]
        begin, end = struct.pack("<I", model.begin), struct.pack("<I", model.end)
        for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
            ids = [begin + encode(text.as_py()) + end for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the ``text`` that the ids stand for."""
    make = model_maker(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
            packed = [ids.as_py() for ids in batch.column(1)]
            texts = [decoded(model, list(struct.unpack(f"<{len(ids) >> 2}I", ids))) for ids in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op11_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), path), path)
    return done.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
