"""Quality classifier by compression: a text is like what a dictionary of its kind shrinks.

One zstandard dictionary is built from good and one from bad labelled text. A text is
compressed in blocks with either; the difference of the two sizes, as a share of the
text's bytes, is the main feature. The share that plain compression leaves and the length
join it in a logistic calibration, fitted on labelled rows that no dictionary saw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bounds of the labelled sample: documents a class, and blocks a class for its dictionary.
SAMPLE_DOCS = 2400
SAMPLE_BLOCKS = 4000
BLOCK_CHARS = 2000
DICTIONARY_BYTES = 112_640
#: Bytes compressed at once, so that the dictionary counts throughout a long text.
BLOCK_BYTES = 1000
LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] = ()
    #: score of every text where the labels hold one class only or none
    constant: float | None = None


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; few or uniform samples, which can't be trained on, serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICTIONARY_BYTES]


def _compressors(model: CompressionModel) -> list[zstandard.ZstdCompressor]:
    lean = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    made = []
    for content in (model.good, model.bad):
        kept = zstandard.ZstdCompressionDict(content)
        kept.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=kept, **lean))
    return [*made, zstandard.ZstdCompressor(**lean)]


def _features(text: str | None, compressors: list[zstandard.ZstdCompressor]) -> list[float]:
    """[1, (bad - good) / n, (bad - good) / larger, plain / n, log n] of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return [1.0, 0.0, 0.0, 1.0, 0.0]
    good, bad, plain = compressors
    parts = [raw[i:i + BLOCK_BYTES] for i in range(0, n, BLOCK_BYTES)]
    g = sum(len(good.compress(p)) for p in parts)
    b = sum(len(bad.compress(p)) for p in parts)
    return [1.0, (b - g) / n, (b - g) / max(g, b), len(plain.compress(raw)) / n, float(np.log(n))]


def features(model: CompressionModel, text: Column) -> Column:
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = _compressors(model)
        for texts in batches:
            yield pd.Series([_features(t, compressors) for t in texts], dtype=object)
    return F.pandas_udf(made, "array<double>")(text)


def score(model: CompressionModel, text: Column) -> Column:
    """Probability of label 1 for a whole text; null and empty texts are scored as empty."""
    if model.constant is not None:
        return F.lit(float(model.constant))
    weights = np.array(model.weights)

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = _compressors(model)
        for texts in batches:
            yield pd.Series([_sigmoid(float(weights @ _features(t, compressors))) for t in texts],
                            dtype="float64")
    return F.pandas_udf(scored, "double")(text)


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def _logistic(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Weights of a ridge logistic regression on both classes at equal weight, moved to ``prior``."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    mean[0], spread[0] = 0, 1
    z = (x - mean) / spread
    each = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        grad = z.T @ (each * (p - y)) + 0.05 * w
        step = np.linalg.solve((z * (each * p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    w = w / spread
    w[0] -= w[1:] @ mean[1:]
    w[0] += np.log(prior / (1 - prior))
    return w


def fit(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> CompressionModel:
    """Fit on a bounded sample: SAMPLE_DOCS documents a class, picked by a hash of their id.

    ``held_out`` (over the id) names ids whose labels are not read. Ids with a null or
    contradictory label are left out; of rows that repeat an id the smallest text counts.
    Two thirds of the sample make the dictionaries, from at most SAMPLE_BLOCKS blocks of
    BLOCK_CHARS a class; the rest, and the share of label 1 among all labels, calibrate.
    Where a class is missing on either side, every score is that share (0.5 without labels).
    """
    ids = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_label"))
    ids = ids.where(F.col(id_col).isNotNull() & F.col("_label").isin(0, 1))
    if held_out is not None:
        ids = ids.where(~held_out)
    ids = (ids.groupBy(id_col).agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
           .where("_label = _other").drop("_other"))
    ids = written(ids, "labels")
    share = ids.agg(F.avg("_label")).first()[0]
    picked = [ids.where(F.col("_label") == c).orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_DOCS)
              for c in (0, 1)]
    picked = picked[0].unionByName(picked[1]).select(F.col(id_col).alias("_id"), "_label")
    sample = written(docs.select(id_col, text_col)
                     .join(F.broadcast(picked), F.col(id_col) == F.col("_id"))  # at most 2 * SAMPLE_DOCS rows
                     .groupBy("_id", "_label").agg(F.min(F.coalesce(text_col, F.lit(""))).alias("_text"))
                     .withColumn("_fit", F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(3)) < 2), "sample")
    blocks = []
    for c in (0, 1):
        cut = (sample.where((F.col("_label") == c) & F.col("_fit") & (F.length("_text") > 0))
               .withColumn("_at", F.explode(F.sequence(F.lit(0), F.length("_text") - 1, F.lit(BLOCK_CHARS))))
               .orderBy(F.xxhash64("_id", "_at"), "_id", "_at").limit(SAMPLE_BLOCKS)
               .select(F.expr(f"substring(_text, _at + 1, {BLOCK_CHARS})")))
        blocks.append([r[0].encode("utf-8", "surrogatepass") for r in cut.collect()])
    if not (blocks[0] and blocks[1]):
        return CompressionModel(b"", b"", constant=0.5 if share is None else share)
    model = CompressionModel(good=_dictionary(blocks[1]), bad=_dictionary(blocks[0]))
    rest = (sample.where("not _fit").select("_label", features(model, F.col("_text")).alias("f"))
            .collect())  # at most 2 * SAMPLE_DOCS rows of five numbers
    y = np.array([r["_label"] for r in rest])
    if not 0 < y.sum() < len(y):
        return CompressionModel(b"", b"", constant=share)
    x = np.array([r["f"] for r in rest])
    prior = min(max(share, 0.02), 0.98)
    return CompressionModel(model.good, model.bad, tuple(map(float, _logistic(x, y, prior))))


def classify(df: DataFrame, model: CompressionModel, text_col: str = "text",
             threshold: float = 0.7) -> DataFrame:
    """``df`` with score and predicted (replacing columns of these names).

    Every row gets a score, from its whole text alone. Repeated rows score alike; an empty
    table gives an empty result.
    """
    return (df.drop("score", "predicted").withColumn("score", score(model, F.col(text_col)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
