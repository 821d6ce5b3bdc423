"""Quality classifier: regularised quadratic discriminant over transformed text statistics.

Each class is a Gaussian over the statistics. Its covariance is shrunk towards the pooled
diagonal; the Cholesky factor is kept, so that scoring is one triangular product for a
batch. The score is the logistic of the difference of the two log densities, whose
Mahalanobis parts come from those factors, plus the classes' log prior ratio.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexloom.llm import textvec as tv
from hexloom.llm.bands import _per_doc, dup_lines, repeat_words
from hexloom.llm.workspace import materialize, named, table, unboxed

STATISTICS = ("words", "word_length", "distinct_words", "top_word", "repeated_words", "repeated_lines", "line_words", "upper", "symbols", "bars", "digits", "marks", "exclaims", "accents")
SHRINKAGE, FLOOR, TEMPER, THRESHOLD = 0.1, 1e-3, 0.5, 0.7
_U = np.uint64


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


UPPER, SYMBOL, BAR = _mask(bytes(range(65, 91))), _mask(b"#*$%&<>"), _mask(b"|")
DIGIT, MARK, EXCLAIM = _mask(b"0123456789"), _mask(b".,;:?"), _mask(b"!")
LETTER = _mask(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(192, 256)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text; shares go through a square root, sizes through a log."""
    n = len(offsets) - 1
    words = tv.Words(data, offsets)
    count = np.diff(words.per_doc).astype(float)
    each = np.maximum(count, 1)
    lead = (data & 0xC0) != 0x80
    letters = np.maximum(_per_doc(LETTER[data], offsets), 1)
    solid = _per_doc(lead & ~tv.WHITE[data], offsets)
    doc, _, times = tv.distinct(words.doc, words.hash)
    top = np.zeros(n)
    np.maximum.at(top, doc, times)
    lines = _per_doc(data == 10, offsets) + 1
    share = lambda x, of: np.sqrt(x / of)
    black = np.maximum(solid, 1)
    return np.stack(
        [
            np.log1p(count),
            np.log1p(solid / each),
            np.bincount(doc, minlength=n) / each,
            share(top, each),
            share(repeat_words(words), each),
            share(dup_lines(data, offsets), lines),
            np.log1p(count / lines),
            share(_per_doc(UPPER[data], offsets), letters),
            share(_per_doc(SYMBOL[data], offsets), black),
            share(_per_doc(BAR[data], offsets), black),
            share(_per_doc(DIGIT[data], offsets), black),
            share(_per_doc(MARK[data], offsets), black),
            share(_per_doc(EXCLAIM[data], offsets), black),
            share(_per_doc(lead & (data >= 128), offsets), black),
        ],
        axis=1,
    )


@dataclass
class Model:
    """Means, inverse Cholesky factors and log determinants of classes 0 and 1, and log prior ratio."""

    mean: np.ndarray
    factor: np.ndarray
    logdet: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        density = []
        for c in (0, 1):
            z = (x - self.mean[c]) @ self.factor[c].T
            density.append(-0.5 * np.einsum("ij,ij->i", z, z) - 0.5 * self.logdet[c])
        return 1 / (1 + np.exp(-np.clip(TEMPER * (density[1] - density[0]) + self.prior, -50, 50)))


def _moment_rows(batches):
    """Sums of 1, x and x x' of each class, for each Arrow batch."""
    d = len(STATISTICS)
    for batch in batches:
        x = batch.column("x").flatten().to_numpy().reshape(-1, d)
        y = batch.column("quality").to_numpy()
        one = np.concatenate([np.ones((len(x), 1)), x], axis=1)
        for c in (0, 1):
            m = one[y == c].T @ one[y == c]
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, c)), pa.array(i.ravel()), pa.array(j.ravel()), pa.array(m.ravel())], ["c", "i", "j", "v"])


def fit(labelled: DataFrame) -> Model:
    """Model from all rows of ``(x array<double>, quality int)``; the sums are added up in Spark.

    A class without rows takes the other's moments; without any rows every score is 0.5.
    """
    d = len(STATISTICS)
    sums = labelled.mapInArrow(_moment_rows, "c long, i long, j long, v double").groupBy("c", "i", "j").agg(F.sum("v").alias("v"))
    m = np.zeros((2, d + 1, d + 1))
    for r in sums.collect():  # 2 (d+1)^2 rows
        m[r.c, r.i, r.j] = r.v
    n = m[:, 0, 0]
    if not n.sum():
        return Model(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), 0.0)
    for c in (0, 1):
        if not n[c]:
            m[c] = m[1 - c]
    size = m[:, 0, 0]
    mean = m[:, 0, 1:] / size[:, None]
    cov = np.stack([m[c, 1:, 1:] / size[c] - np.outer(mean[c], mean[c]) for c in (0, 1)])
    pooled = np.diag(np.diag((size[:, None, None] * cov).sum(0) / size.sum())) + FLOOR * np.eye(d)
    factor, logdet = [], []
    for c in (0, 1):
        low = np.linalg.cholesky((1 - SHRINKAGE) * cov[c] + SHRINKAGE * pooled)
        factor.append(np.linalg.inv(low))
        logdet.append(2 * np.log(np.diag(low)).sum())
    return Model(mean, np.stack(factor), np.array(logdet), float(np.log((n[1] + 1) / (n[0] + 1))))


def _statistic_rows(batches):
    for rows, data, offsets in tv.text_rows(batches):
        x = statistics(data, offsets)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS)), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([rows.column("row"), lists], ["row", "x"])


def _score_rows(model: Model, names: list[str]):
    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(model.score(x))], [*names, "score"])

    return run


def text_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the statistics ``x`` of each whole text; null counts as empty."""
    rows = docs.select(F.struct(*map(named, keep)).alias("row"), named(text).alias("text"))
    return rows.mapInArrow(_statistic_rows, T.StructType([rows.schema["row"], T.StructField("x", T.ArrayType(T.DoubleType()))])).select(*unboxed(list(keep), "x"))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``key``, held_out, score and predicted of each row of ``docs``.

    Learns from all rows of ``labels`` (``key``, quality) whose crc32 of the id as text is not 2
    modulo 4; several labels of one id count as their rounded mean, and null labels or ids not at
    all. The score is between 0 and 1, higher where label 1 is likelier; empty and null
    texts are scored too. A row without id is scored and not held out. Repeated rows get
    equal scores; an empty table gives an empty result.
    """
    x = materialize(text_statistics(docs, text, (key,)), "statistics")
    out_of = F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
    known = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.round(F.avg("quality")).cast("long").alias("quality"))
    model = fit(x.where(~out_of).join(known, key).select("x", "quality"))
    out = T.StructType([docs.schema[key], T.StructField("score", T.DoubleType())])
    scored = x.mapInArrow(_score_rows(model, [key]), out)
    return scored.select(key, out_of.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op3(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
