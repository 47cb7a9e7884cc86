"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi.

The pieces and their scores come from a ``.model`` file. The automaton holds
all pieces; at each position its output links give the pieces that end there,
and each relaxes the best score of that position. The path of the highest sum
of scores is the encoding (the unigram rule of the library, over the file's
scores); ties go to the path whose last piece is longest. A character that no
piece covers costs the lowest score less 10 and is written as its UTF-8 bytes
where the file has byte pieces, else as the unknown piece.

No piece has the space mark after another character, so no piece crosses into
the next word: the best path of a text is that of its words, one after the
other, and a worker remembers the encodings of the words met last.

Texts are normalised as the library does without a character map: spaces
become the mark, one is put in front, runs of spaces stay or shrink as the
model file says. Decoding gives exactly the normalised text.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

MARK = "▁"
UNKNOWN_PENALTY = 10.0
WORDS_KEPT = 150_000
MODEL_ENV = "DIMSMITH_SENTENCEPIECE_MODEL"
# Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def model_path() -> str:
    """The model file: the environment names it, else the installed vocabularies do."""
    if os.environ.get(MODEL_ENV):
        return os.environ[MODEL_ENV]
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value
    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at:at + n]
        at += n


class PieceModel:
    """Encoder and decoder over the pieces of a model file."""

    def __init__(self, data: bytes, words_kept: int = WORDS_KEPT):
        self.pieces: list[str] = []
        scores, kinds = [], []
        self.dummy_prefix, self.shrink = True, True
        for number, value in _fields(data):
            if number == 1:
                got = dict(_fields(value))
                self.pieces.append(got.get(1, b"").decode())
                scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
                kinds.append(got.get(3, NORMAL))
            elif number == 3:
                got = dict(_fields(value))
                self.dummy_prefix, self.shrink = bool(got.get(3, 1)), bool(got.get(4, 1))
                if got.get(2):
                    raise ValueError("model files with a character map are not handled")
        self.kinds = kinds
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): k for k, (p, t) in enumerate(zip(self.pieces, kinds)) if t == BYTE}
        self.byte_of = {k: bytes([b]) for b, k in self.bytes.items()}
        usable = [(p, k) for k, p in enumerate(self.pieces) if kinds[k] in (NORMAL, USER) and p]
        if any(MARK in p.lstrip(MARK) for p, _ in usable):
            raise ValueError("a piece crosses into the next word")
        self.unk_score = min(s for s, t in zip(scores, kinds) if t == NORMAL) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, k in usable:
            self.automaton.add_word(p, (len(p), k, scores[k]))
        self.automaton.make_automaton()
        #: What each id stands for in a text; unknown and control ids give nothing.
        self.text_of = [self.byte_of.get(k) or (p.encode() if t in (NORMAL, USER) else b"")
                        for k, (p, t) in enumerate(zip(self.pieces, kinds))]
        self.words_kept = words_kept
        #: Ids of words (less the space mark that opens them) met last, and before.
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def normalise(self, text: str) -> str:
        if self.shrink:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", MARK)
        return MARK + text if self.dummy_prefix and text else text

    def viterbi(self, word: str) -> tuple[int, ...]:
        """Ids of the best path through one word, space marks in front included."""
        n = len(word)
        best: list[float] = [0.0] + [float("-inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0  # positions up to here have their final score

        def close(upto: int) -> None:
            # A character of its own where no piece of one character ends.
            nonlocal done
            while done < upto:
                done += 1
                if not single[done]:
                    score = best[done - 1] + self.unk_score
                    if score > best[done]:
                        best[done], back[done] = score, (done - 1, self.unknown)

        single = bytearray(n + 1)
        for end, (length, piece, score) in self.automaton.iter(word):
            end += 1
            close(end - 1)
            if length == 1:
                single[end] = 1
            start = end - length
            total = best[start] + score
            if total > best[end] or total == best[end] and start < back[end][0]:
                best[end], back[end] = total, (start, piece)
        close(n)
        path = []
        while n:
            start, piece = back[n]
            if piece != self.unknown:
                path.append(piece)
            elif self.bytes:
                path.extend(self.bytes[b] for b in reversed(word[start:n].encode("utf-8", "surrogatepass")))
            else:
                path.append(piece)
            n = start
        return tuple(reversed(path))

    def packed(self, text: str | None) -> bytes:
        """Ids of the text, four bytes each; the words met last are remembered."""
        if not text:
            return b""
        first = b""
        if self.dummy_prefix and not text.startswith(" ") and "  " not in text and MARK not in text:
            words = text.encode("utf-8", "surrogatepass").split(b" ")  # each opens with one mark
        else:
            units = _words(self.normalise(text))
            if units and not units[0].startswith(MARK):
                first = array("i", self.viterbi(units.pop(0))).tobytes()
            words = [w[1:].encode("utf-8", "surrogatepass") for w in units]
        step = self.words_kept
        return first + b"".join(self._packed(words[at:at + step]) for at in range(0, len(words), step))

    def _packed(self, words: list[bytes]) -> bytes:
        new = set(words).difference(self.kept)
        if new and len(self.kept) + len(new) > self.words_kept:
            self.older, self.kept = self.kept, {}
            new = set(words)
        kept, older = self.kept, self.older
        for word in new:
            ids = older.get(word)
            if ids is None:
                ids = array("i", self.viterbi(MARK + word.decode("utf-8", "surrogatepass"))).tobytes()
            kept[word] = ids
        return b"".join(map(kept.__getitem__, words))

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text), np.int32)

    def encode(self, text: str | None) -> list[int]:
        return self.ids(text).tolist()

    def decode_normalised(self, ids: Sequence[int]) -> str:
        """The normalised text of ids; bytes that form no character give the replacement character."""
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")

    def decode(self, ids: Sequence[int]) -> str:
        text = self.decode_normalised(ids).replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def _words(text: str) -> list[str]:
    """Cut before each run of space marks that follows another character."""
    if MARK + MARK in text:
        return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text)
    first, *rest = text.split(MARK)
    return ([first] if first else []) + [MARK + w for w in rest]


_MODELS: dict[tuple[str, int], PieceModel] = {}


def _model(path: str, words_kept: int = WORDS_KEPT) -> PieceModel:
    """One model a worker process."""
    if (path, words_kept) not in _MODELS:
        with open(path, "rb") as f:
            _MODELS[path, words_kept] = PieceModel(f.read(), words_kept)
    return _MODELS[path, words_kept]


def encode(docs: DataFrame, column: str = "ids", text_col: str = "text", path: str | None = None,
           words_kept: int = WORDS_KEPT) -> DataFrame:
    """``docs`` with an array of piece ids; a null text has none (an empty array).

    ``words_kept`` words a worker remembers trade memory for work; the ids are the same."""
    path = path or model_path()

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        model = _model(path, words_kept)
        return pd.Series([model.ids(t) for t in texts], dtype=object)
    return docs.withColumn(column, ids(F.col(text_col)))


def decode(rows: DataFrame, column: str = "text", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``rows`` with the text of an array of piece ids; null ids give null."""
    path = path or model_path()

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        model = _model(path)
        return pd.Series([None if x is None else model.decode([int(k) for k in x]) for x in ids], dtype=object)
    return rows.withColumn(column, text(F.col(ids_col)))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_crc32 (ids as little-endian unsigned 32-bit) and round_trip.

    round_trip says that decoding the ids gives back the normalised text.
    """
    path = path or model_path()

    @F.pandas_udf("n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean")
    def digest(texts: pd.Series) -> pd.DataFrame:
        model, out = _model(path), []
        first, last = (min(model.byte_of), max(model.byte_of)) if model.byte_of else (1, 0)
        for t in texts:
            packed = model.packed(t)
            ids = np.frombuffer(packed, "<u4")
            out.append((len(ids), int(((ids >= first) & (ids <= last)).sum()), zlib.crc32(packed),
                        model.decode_normalised(ids.tolist()) == model.normalise(t or "")))
        return pd.DataFrame(out, columns=["n_pieces", "n_byte_pieces", "ids_crc32", "round_trip"])
    x = fresh(docs, "x")
    return docs.select(F.col(id_col).alias("doc_id"), digest.asNondeterministic()(F.col(text_col)).alias(x)).select(
        "doc_id", f"{x}.*")
