"""SentencePiece encoding and decoding over a given piece vocabulary.

An Aho-Corasick automaton holds all pieces. One pass over a text reports, at
every position, the pieces that end there, longest first along the output
links; each of them relaxes the best score of that position, so the pass is
the Viterbi search for the segmentation of the greatest total score. Scores
are the model's own; a character without a piece costs ``lowest - 10`` and
becomes its UTF-8 bytes. Of equal scores the longer last piece wins.

No piece of the vocabulary crosses from a non-blank into a blank, so the best
segmentation of a text is that of its blank-led words one after another; the
words' segmentations are kept in a bounded memo. (A vocabulary with crossing
pieces is searched text by text.)

Spaces are written as U+2581, with one before the text. U+2581 in the text
itself becomes its three bytes, so decoding gives back every text exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import BoundedCache, small_batches

BLANK = "▁"
NORMAL, BYTE, OTHER = 0, 1, 2
MEMO = 300_000


def load_vocabulary(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id, read on the driver from a model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = [BYTE if model.is_byte(i) else OTHER if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
             else NORMAL for i in range(model.get_piece_size())]
    return [(model.id_to_piece(i), model.get_score(i), k) for i, k in enumerate(kinds)]


class Codec:
    def __init__(self, vocabulary: list[tuple[str, float, int]]):
        self.automaton, self.single = ahocorasick.Automaton(), set()
        self.bytes_of, self.byte_id, lowest = [], {}, 0.0
        crossing = newline = False
        for i, (piece, score, kind) in enumerate(vocabulary):
            if kind == BYTE:
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
                continue
            if kind == OTHER or not piece:
                self.bytes_of.append(b"")
                continue
            self.automaton.add_word(piece, (i, len(piece), score))
            self.bytes_of.append(piece.replace(BLANK, " ").encode())
            lowest = min(lowest, score)
            if len(piece) == 1:
                self.single.add(piece)
            crossing |= BLANK in piece.lstrip(BLANK)
            newline |= "\n" in piece and len(piece) > 1
        self.automaton.make_automaton()
        if len(self.byte_id) < 256:
            raise ValueError("the vocabulary needs a piece for each byte")
        self.unknown = lowest - 10
        if crossing:
            self.units = lambda s: [s] if s else []
        elif newline:
            self.units = re.compile("%s*[^%s]+|%s+" % (BLANK, BLANK, BLANK)).findall
        else:  # no piece joins a newline with anything else
            self.units = re.compile("%s*[^%s\n]+|%s+|\n" % (BLANK, BLANK, BLANK)).findall
        self.memo = BoundedCache(self._unit, MEMO)
        self.blank_bytes = np.array([self.byte_id[x] for x in BLANK.encode()], np.int32).tobytes()

    def segment(self, s: str) -> list[int]:
        """Viterbi over ``s``: the ids of its best segmentation."""
        n = len(s)
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        known = self.single.issuperset(s)
        at = 0  # positions up to here have their final score
        for end, (piece, size, score) in self.automaton.iter(s):
            end += 1
            if not known:
                while at < end - 1:
                    at += 1
                    self._by_bytes(s, at, best, back)
            total = best[end - size] + score
            if total > best[end]:
                best[end], back[end] = total, (piece, size)
        if not known:
            while at < n:
                at += 1
                self._by_bytes(s, at, best, back)
        ids: list[int] = []
        while n:
            piece, size = back[n]
            if piece < 0:
                ids += [self.byte_id[x] for x in reversed(s[n - 1].encode())]
            else:
                ids.append(piece)
            n -= size
        return ids[::-1]

    def _by_bytes(self, s: str, end: int, best: list, back: list) -> None:
        if s[end - 1] not in self.single and best[end - 1] + self.unknown > best[end]:
            best[end], back[end] = best[end - 1] + self.unknown, (-1, 1)

    def _unit(self, unit: str) -> bytes:
        return np.array(self.segment(unit), np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids (int32) of a text; none for an empty one."""
        if not text:
            return np.zeros(0, np.int32)
        get, parts = self.memo.__getitem__, []
        for i, part in enumerate(text.split(BLANK)):
            part = part.replace(" ", BLANK)
            if i:
                parts.append(self.blank_bytes)
            else:
                part = BLANK + part
            parts.append(b"".join(map(get, self.units(part))))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def _codec(key: str, sent) -> Codec:
    """One codec per worker process and vocabulary."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(sent.value)
    return _codecs[key]


def _with_column(df: DataFrame, text_col: str, name: str, kind: T.DataType, vocabulary, make) -> DataFrame:
    """``df`` with one more column, made per row from another by the codec."""
    small_batches(df.sparkSession)
    src = df.drop(name) if name != text_col else df
    schema = T.StructType([*src.schema.fields, T.StructField(name, kind)])
    at = src.columns.index(text_col)
    # a bounded list, whatever the table's size
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)
    key = hashlib.md5(repr(vocabulary).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, sent)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, make(codec, b.column(at))],
                                             names=[*b.schema.names, name])

    return src.mapInArrow(run, schema)


def _encoded(codec: Codec, texts: pa.Array) -> pa.Array:
    each = [None if t is None else codec.encode(t) for t in texts.to_pylist()]
    sizes = [0 if x is None else len(x) for x in each]
    offsets = np.zeros(len(each) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = np.concatenate([x for x in each if x is not None] or [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values),
                                    mask=pa.array([x is None for x in each], pa.bool_()))


def _decoded(codec: Codec, ids: pa.Array) -> pa.Array:
    flat, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return pa.array([None if null[i] else codec.decode(flat[offsets[i]:offsets[i + 1]]) for i in range(len(ids))],
                    pa.string())


def encode(df: DataFrame, vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of ``df`` plus ``ids_col``, an array of piece ids.

    A null text has null ids, an empty text none; whole texts of any length
    are encoded; rows are independent of each other. An input column named
    ``ids_col`` is replaced."""
    return _with_column(df, text_col, ids_col, T.ArrayType(T.IntegerType()), vocabulary, _encoded)


def decode(df: DataFrame, vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` plus ``text_col``, the text that the ids spell
    (null for null)."""
    return _with_column(df, ids_col, text_col, T.StringType(), vocabulary, _decoded)


def ids_digest(ids) -> F.Column:
    """Hex SHA-256 of the ids, comma-joined."""
    return F.sha2(F.array_join(ids, ","), 256)
