"""Language ID by a byte convolutional network, trained here in numpy.

Network: one-hot bytes -> filters of several widths -> ReLU -> max pooling
over the window -> softmax. A filter bank of width w over one-hot bytes is w
tables of 256 rows, so a convolution is w table look-ups and sums.

Training reads a bounded sample of whole labelled texts: of each language the
``SAMPLE_DOCS`` documents with the smallest hash of their id (a top-k over
ids, no texts), so a rare language is learned as well. It runs on the driver
in a few seconds and always gives the same network for the same sample.

Prediction reads whole texts: each text is cut into windows of ``WINDOW``
bytes without gaps, the windows of many texts are classified as one batch, and
a text's score per language is the mean over its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import LOWER_TABLE, has_letter, small_batches

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
SAMPLE_DOCS = 300
#: languages whose sample bounds may be broadcast
LANGUAGES = 10_000
EPOCHS = 8
BATCH_WINDOWS = 128
UNKNOWN = "und"


def windows_of(text: bytes) -> np.ndarray:
    """The text (A-Z lower-cased) as rows of WINDOW bytes, zeros behind the
    end."""
    data = np.frombuffer(text.translate(LOWER_TABLE), np.uint8)
    out = np.zeros(-(-max(1, len(data)) // WINDOW) * WINDOW, np.uint8)
    out[:len(data)] = data
    return out.reshape(-1, WINDOW)


class ByteCNN:
    """``tables[i][k]``: (256, FILTERS), what byte k of a filter of width
    WIDTHS[i] adds; ``out``: (features, languages)."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def pooled(self, x: np.ndarray, where: bool = False):
        """Max-pooled features of windows x; with ``where`` also the places of
        the maxima."""
        feats, places = [], []
        for table, bias, w in zip(self.tables, self.bias, WIDTHS):
            y = table[0][x[:, :WINDOW - w + 1]]
            for k in range(1, w):
                y += table[k][x[:, k:WINDOW - w + 1 + k]]
            if where:
                at = y.argmax(1)
                places.append(at)
                top = np.take_along_axis(y, at[:, None, :], 1)[:, 0]
            else:
                top = y.max(1)
            feats.append(np.maximum(top + bias, 0))
        feats = np.concatenate(feats, 1)
        return (feats, places) if where else feats

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if len(x) > BATCH_WINDOWS:
            return np.concatenate([self.probabilities(x[i:i + BATCH_WINDOWS])
                                   for i in range(0, len(x), BATCH_WINDOWS)])
        return _softmax(self.pooled(x) @ self.out + self.out_bias)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the cross-entropy, each language with equal weight."""
        rng = np.random.default_rng(seed)
        weight = (len(y) / len(self.languages) / np.maximum(1, np.bincount(y, minlength=len(self.languages))))
        params = [*self.tables, *self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in np.array_split(order, max(1, len(y) // 64)):
                step += 1
                grads = self._gradients(x[at], y[at], weight[y[at]].astype(np.float32))
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    def _gradients(self, x, y, weight):
        feats, places = self.pooled(x, where=True)
        p = _softmax(feats @ self.out + self.out_bias)
        p[np.arange(len(y)), y] -= 1
        p *= weight[:, None] / len(y)
        back = (p @ self.out.T) * (feats > 0)
        tables, bias = [], []
        rows = np.arange(len(y))[:, None]
        for i, w in enumerate(WIDTHS):
            g = back[:, i * FILTERS:(i + 1) * FILTERS]
            grad = np.zeros_like(self.tables[i])
            for k in range(w):  # only the byte windows of the maxima get a gradient
                np.add.at(grad[k], (x[rows, places[i] + k], np.arange(FILTERS)[None, :]), g)
            tables.append(grad)
            bias.append(g.sum(0))
        return [*tables, *bias, feats.T @ p, p.sum(0)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def held_out(id_col) -> F.Column:
    """Documents kept out of the training: crc32 of the id as text, mod 4, is
    2; null ids are never trained on and not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS) -> ByteCNN | None:
    """A network from the labelled rows that are not held out, None if there
    is none. The whole texts of at most ``sample_docs`` documents of each
    language reach the driver; texts without a letter are not learned from,
    and of rows that repeat an id only that many count."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.xxhash64(F.lit("langid"), docs[id_col]).alias("r"), docs[lang_col].cast("string").alias("lang"),
                       docs[text_col].cast("string").alias("text"), docs[id_col].alias("id"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull()
                      & ~held_out(F.col("id")))
    order = Window.partitionBy("lang").orderBy("r")
    last = (rows.select("lang", "r").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample_docs)
            .groupBy("lang").agg(F.max("r").alias("last")))
    bounds = {r["lang"]: r["last"] for r in last.toLocalIterator()}  # a row per language
    if not bounds:
        return None
    marks = docs.sparkSession.createDataFrame(list(bounds.items()), "lang string, last long")
    chosen = rows.join(F.broadcast(marks) if len(bounds) <= LANGUAGES else marks, "lang")
    chosen = (chosen.where(F.col("r") <= F.col("last")).select("lang", "r", "text")
              .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("r", "text")))
              .where(F.col("nth") <= sample_docs).select("r", "lang", "text"))
    x, y = [], []
    for row in sorted(chosen.toLocalIterator(), key=lambda t: (t["lang"], t["r"], t["text"])):
        if has_letter(row["text"]):
            x.append(windows_of(row["text"].encode()))
            y += [row["lang"]] * len(x[-1])
    if not x:
        return None
    languages = sorted(set(y))
    model = ByteCNN(languages)
    model.train(np.concatenate(x), np.searchsorted(languages, y))
    return model


def predict(docs: DataFrame, model: ByteCNN | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``lang_score`` (0 to 1).

    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text if nothing could be learned. Only the text decides. Input
    columns of these two names are replaced."""
    small_batches(docs.sparkSession)
    src = docs.drop(*[c for c in ("lang_pred", "lang_score") if c != text_col])
    at = src.columns.index(text_col)
    schema = T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score = [UNKNOWN] * b.num_rows, [0.0] * b.num_rows
            held, owners, n = [], [], 0

            def classify():
                p = model.probabilities(np.concatenate(held))
                start = np.cumsum([0] + [len(h) for h in held[:-1]])
                mean = np.add.reduceat(p.astype(np.float64), start, axis=0) / np.array([len(h) for h in held])[:, None]
                for i, k, s in zip(owners, mean.argmax(1), mean.max(1)):
                    pred[i], score[i] = model.languages[k], min(1.0, float(s))

            for i, text in enumerate(b.column(at).to_pylist()):
                if model is None or text is None or not has_letter(text):
                    continue
                held.append(windows_of(text.encode()))
                owners.append(i)
                n += len(held[-1])
                if n >= 8_192:
                    classify()
                    held, owners, n = [], [], 0
            if held:
                classify()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred), pa.array(score, pa.float64())],
                                             names=schema.names)

    return src.mapInArrow(run, schema)
