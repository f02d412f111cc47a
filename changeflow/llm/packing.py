"""Token-ID output: documents packed into matrices of fixed-length rows.

Texts become token ids; documents longer than a row are split into row-sized
pieces without loss; the pieces are placed best-fit-decreasing: longest first,
each into the row with the least room that still holds it, found by a search
in a segment tree over room sizes. A task packs its own documents, a block of
at most ``BLOCK_TOKENS`` tokens at a time (a longer document is a block of its
own), so nothing is shuffled, memory is bounded, and a lost task is simply run
again; a block wastes at most its last rows.

Output: a Parquet table, a row per block (binary columns, little endian):

* ``ids``: the id matrix, n_rows x row_len (uint16 if all ids fit, else
  uint32), ``pad_id`` behind a row's last piece;
* ``cu_seqlens``: cumulative piece lengths over the flattened matrix, row by
  row, each row closed by its padding (n_rows x row_len at the end);
* ``resets``: the flat places at which positions begin at 0 again;
* ``piece_doc``, ``piece_no``, ``piece_at``, ``piece_len``: which document and
  which piece of it stands where.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import id_and_text, small_batches

ROW_LEN = 2_048
BLOCK_TOKENS = 2_000_000
#: characters of texts whose different words are encoded together
CHUNK_CHARS = 4_000_000
#: other white space than space and newline, with which a text is encoded whole
_ODD_BLANK = re.compile(r"[^\S \n]")


def load_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a rank file, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Tokenizer:
    """Byte-level BPE over given ranks. The split pattern joins no character
    with a space behind it, and of a run of blanks at most the last one with
    what follows. So where no two spaces stand together, a text is its words,
    each with the space before it, encoded one by one; and of many texts each
    different word is encoded once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.dtype = np.dtype("<u2" if max(ranks.values()) < 65_535 else "<u4")
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = [len(b) for b in ranks]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), self.dtype)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list = [None] * len(texts)
        plain, words = [], []
        for i, text in enumerate(texts):
            first, *rest = text.split(" ")
            if "" in rest or _ODD_BLANK.search(text):
                out[i] = self.encode(text)
            else:
                plain.append((i, first, len(rest)))
                words += rest
        found = pa.array(words, pa.large_string()).dictionary_encode()
        different = found.dictionary
        line = np.array(self.encoding.encode_ordinary("".join([" " + w for w in different.to_pylist()])), self.dtype)
        # the ids of a word end where its bytes end
        ends = np.cumsum(pc.binary_length(different).to_numpy() + 1)
        reach = np.cumsum(self.sizes[line])
        last = np.searchsorted(reach, ends)
        if len(ends) and not (reach[last] == ends).all():
            raise ValueError("the split pattern joins words across a space")
        stop = np.append(0, last + 1)
        number = found.indices.to_numpy()
        begin, size = stop[number], stop[number + 1] - stop[number]
        upto = np.append(0, np.cumsum(size))
        flat = line[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
        at = 0
        for i, first, n in plain:
            out[i] = np.concatenate([self.encode(first), flat[upto[at]:upto[at + n]]])
            at += n
        return out


_tokenizers: dict[str, Tokenizer] = {}


def _tokenizer(name: str, sent) -> Tokenizer:
    """One tokenizer per worker process and call of ``pack``."""
    if name not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[name] = Tokenizer(*sent.value)
    return _tokenizers[name]


class RoomTree:
    """Segment tree over room sizes 0..row_len: a leaf counts the rows with
    just that much room, an inner node those below it."""

    def __init__(self, row_len: int):
        self.size = 1 << row_len.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(row_len + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room of ``need`` or more, and its room."""
        i = need + self.size
        if not self.count[i]:
            # up until a right-hand neighbour has rows, then down to its first
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        self._change(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, row_len: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and offset for pieces of 1..row_len tokens, and the row count."""
    row, offset, rows = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    tree = RoomTree(row_len)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            found, rows = (rows, row_len), rows + 1
        row[i], offset[i] = found[0], row_len - found[1]
        if found[1] > need:
            tree.add(found[1] - need, found[0])
    return row, offset, rows


def pack_block(docs: list[tuple[int | None, np.ndarray]], row_len: int, pad_id: int, dtype: np.dtype) -> dict:
    piece_doc, piece_no, pieces = [], [], []
    for doc_id, ids in docs:
        for no, start in enumerate(range(0, max(1, len(ids)), row_len)):
            piece_doc.append(doc_id)
            piece_no.append(no)
            pieces.append(ids[start:start + row_len])
    lengths = np.array([len(p) for p in pieces], np.int64)
    full = lengths > 0  # a document without tokens has one empty piece, in no row
    row, offset, n = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), 0
    row[full], offset[full], n = best_fit_decreasing(lengths[full], row_len)
    matrix = np.full(n * row_len, pad_id, dtype)
    at = row * row_len + offset
    for p, start in zip(pieces, at.tolist()):
        matrix[start:start + len(p)] = p
    used = np.zeros(n, np.int64)
    np.maximum.at(used, row[full], (offset + lengths)[full])
    resets = np.sort(at[full])
    padding = (np.arange(n) * row_len + used)[used < row_len]
    cu = np.unique(np.concatenate([[0], resets, padding, [n * row_len]]))
    return {"row_len": row_len, "n_rows": n, "id_bytes": dtype.itemsize, "ids": matrix.tobytes(),
            "cu_seqlens": cu.astype(np.int32), "resets": resets.astype(np.int32), "piece_doc": piece_doc,
            "piece_no": piece_no, "piece_at": at.astype(np.int32), "piece_len": lengths.astype(np.int32)}


def _schema(id_type: T.DataType) -> T.StructType:
    ints = T.ArrayType(T.IntegerType())
    return T.StructType([
        T.StructField("row_len", T.IntegerType()), T.StructField("n_rows", T.IntegerType()),
        T.StructField("id_bytes", T.IntegerType()), T.StructField("ids", T.BinaryType()),
        T.StructField("cu_seqlens", ints), T.StructField("resets", ints),
        T.StructField("piece_doc", T.ArrayType(id_type)), T.StructField("piece_no", ints),
        T.StructField("piece_at", ints), T.StructField("piece_len", ints)])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about CHUNK_CHARS characters."""
    docs, texts, n = [], [], 0
    for b in batches:
        docs += b.column(0).to_pylist()
        texts += b.column(1).to_pylist()
        n += b.column(1).nbytes
        if n >= CHUNK_CHARS:
            yield docs, texts
            docs, texts, n = [], [], 0
    if docs:
        yield docs, texts


def pack(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
         row_len: int = ROW_LEN, pad_id: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The blocks described above, for every row of ``docs``.

    ``pad_id``: the number of ranks if not given. Null and empty texts have
    one piece of no tokens; rows that repeat an id are documents of their own;
    null ids are carried along; an empty table gives no block. Other columns
    of the input are not read."""
    small_batches(docs.sparkSession)
    src = id_and_text(docs, id_col, text_col)
    schema = _schema(src.schema["doc_id"].dataType)
    sent = src.sparkSession.sparkContext.broadcast((ranks, pattern))  # a bounded vocabulary
    pad, name = len(ranks) if pad_id is None else pad_id, uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        tokenizer = _tokenizer(name, sent)
        arrow, held, size = to_arrow_schema(schema), [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([pack_block(held, row_len, pad, tokenizer.dtype)], schema=arrow)

        for docs, texts in _chunks(batches):
            for doc_id, ids in zip(docs, tokenizer.encode_all(texts)):
                if held and size + len(ids) > block_tokens:
                    yield block()
                    held, size = [], 0
                held.append((doc_id, ids))
                size += len(ids)
        if held:
            yield block()

    return src.mapInArrow(run, schema)


def positions(block) -> np.ndarray:
    """The position of each flat place of a block, from its resets."""
    out = np.arange(block["n_rows"] * block["row_len"])
    cu = np.asarray(block["cu_seqlens"])
    return out - np.repeat(cu[:-1], np.diff(cu))


def unpack(blocks: DataFrame) -> DataFrame:
    """doc_id, ids (array), n_pieces for every packed document, read back from
    the matrices alone; the pieces of a document stand in one block."""
    id_type = blocks.schema["piece_doc"].dataType.elementType
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("ids", ints),
                           T.StructField("n_pieces", T.LongType()), T.StructField("first_at", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id_bytes", "ids", "piece_doc", "piece_no", "piece_at", "piece_len"]
        for b in batches:
            for k in range(b.num_rows):
                size, matrix, doc, no, at, length = (b.column(n)[k] for n in names)
                flat = np.frombuffer(matrix.as_py(), "<u%d" % size.as_py())
                no, at, length = (x.values.to_numpy() for x in (no, at, length))
                start = np.flatnonzero(no == 0)
                for lo in range(0, len(start), 256):  # documents at once
                    part = start[lo:lo + 256]
                    end = start[lo + 256] if lo + 256 < len(start) else len(no)
                    ends = np.append(part[1:], end)
                    ids = [flat[at[i]:at[i] + length[i]] for i in range(part[0], end)]
                    sizes = np.add.reduceat(length[part[0]:end], part - part[0])
                    offsets = np.zeros(len(part) + 1, np.int32)
                    np.cumsum(sizes, out=offsets[1:])
                    yield pa.RecordBatch.from_arrays(
                        [doc.values.take(pa.array(part)),
                         pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32))),
                         pa.array((ends - part).astype(np.int64)), pa.array(at[part].astype(np.int64))],
                        names=["doc_id", "ids", "n_pieces", "first_at"])

    small_batches(blocks.sparkSession)
    return blocks.mapInArrow(run, schema)
