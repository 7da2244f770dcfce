"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled web text train a linear model by the non-negative unbiased risk
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)) with the logistic loss, whose value then is the
log-odds of quality. The class prior is estimated from the labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgraph.llm.common import free_names, held_out, sample_by_hash, text_key, with_string_text

#: Classes of UTF-8 bytes: white space, line end, lower case, upper case, digit, full stop or comma, other marks, above ASCII.
_CLASSES = 8
_CLASS = np.full(256, 7, np.uint8)
_CLASS[:128] = 6
for _c, _of in ((0, b" \t\r\x0b\x0c"), (1, b"\n"), (2, bytes(range(97, 123))), (3, bytes(range(65, 91))), (4, b"0123456789"), (5, b".,")):
    _CLASS[list(_of)] = _c
_BLOCK = 1 << 20


def features(text: str | None) -> np.ndarray:
    """Shares of byte classes and of their pairs, and statistics of words and lines; zeros if there are no words."""
    words = text.split() if text else []
    out = np.zeros(2 * _CLASSES + _CLASSES**2 + 8, np.float32)
    if not words:
        return out
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    pairs = np.zeros(_CLASSES**2)
    for at in range(0, len(raw), _BLOCK):
        c = _CLASS[raw[at : at + _BLOCK + 1]]
        pairs += np.bincount(c[:-1] * np.uint8(_CLASSES) + c[1:], minlength=_CLASSES**2)
    single = np.bincount(_CLASS[raw], minlength=_CLASSES) if len(raw) <= _BLOCK else pairs.reshape(_CLASSES, _CLASSES).sum(axis=1)
    single = single / max(1, single.sum())
    n, lines = len(words), text.split("\n")
    seen = Counter(words)
    top, length = max(seen.values()), sum(map(len, words)) / n
    same = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    more = [len(seen) / n, np.log(len(seen)) / np.log(n + 1), top / n, same, len(set(lines)) / len(lines), np.log1p(n) / 10, length / 10, np.log1p(len(lines)) / 10]
    out[:] = np.concatenate([single, np.sqrt(single), np.sqrt(pairs / max(1, pairs.sum())), more])
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float32()))], names=["kind", "x"])


def risk(pos: np.ndarray, unl: np.ndarray, w: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the non-negative unbiased risk before the latter is cut at zero: prior * R+(positives), and
    R-(unlabelled) - prior * R-(positives)."""
    zp, zu = pos @ w, unl @ w
    return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()


def slope(pos: np.ndarray, unl: np.ndarray, w: np.ndarray, prior: float) -> np.ndarray:
    """The risk's gradient; where the negative part is below zero, which is overfitting, the step back out of it."""
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    zp, zu = pos @ w, unl @ w
    negative = unl.T @ sig(zu) / len(unl) - prior * (pos.T @ sig(zp)) / len(pos)
    if risk(pos, unl, w, prior)[1] < 0:
        return -negative
    return negative - prior * (pos.T @ sig(-zp)) / len(pos)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, most: int = 4000, steps: int = 600, rate: float = 0.05, decay: float = 1e-3) -> QualityModel:
        """docs: doc_id, text; labels: doc_id, y (1 good, 0 not). Positives are at most `most` documents with y = 1, the
        unlabelled at most 2 * most of docs whatever their labels, by the lowest hashes of doc_id and text; equal rows
        count once, so no more than 3 * most rows come to the driver. The prior is the share of y = 1 in all labels,
        smoothed; without positives every score is the prior."""
        labels = labels.where("y is not null and doc_id is not null").select("doc_id", "y").distinct()
        got = labels.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0)).alias("p")).first()
        prior = (got.p + 1) / (got.n + 2)
        docs = with_string_text(docs).where("doc_id is not null").select("doc_id", "text", text_key().alias("key"))
        ids = docs.select("doc_id", "key").distinct()
        good = labels.where("y = 1").select("doc_id").distinct()
        pick = lambda df, k, kind: sample_by_hash(df, ["doc_id", "key"], k).select("doc_id", "key", F.lit(kind).alias("kind"))
        chosen = pick(ids.join(good, "doc_id", "left_semi"), most, 1).union(pick(ids, 2 * most, 0))
        rows = docs.join(F.broadcast(chosen), ["doc_id", "key"]).dropDuplicates(["doc_id", "key", "kind"])
        rows = rows.select("kind", "text").mapInArrow(_features, "kind int, x array<float>").collect()
        size = len(features(None))
        x, kind = np.array([r.x for r in rows], np.float64).reshape(-1, size), np.array([r.kind for r in rows])
        if not (kind == 1).any() or not (kind == 0).any():
            return cls(np.zeros(size), np.ones(size), np.zeros(size + 1), prior)
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
        by = np.lexsort([*x.T, kind])  # sums then don't depend on the order of arrival
        x, kind = x[by], kind[by]
        pos, unl = x[kind == 1], x[kind == 0]
        w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
        w[-1] = np.log(prior / (1 - prior))
        for t in range(1, steps + 1):
            g = slope(pos, unl, w, prior) + decay * np.append(w[:-1], 0)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return cls(mean, scale, w, prior)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        if not self.weights.any():
            return np.full(len(texts), self.prior)
        x = np.clip((np.stack([features(t) for t in texts]) - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40)))


def _score(model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.value.score(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return run


def added_name(docs: DataFrame) -> str:
    """Name of the column that quality_scores() adds: __quality, with more underscores if docs has such a column."""
    return free_names(docs, "__quality")[0]


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """docs with its columns, and __quality (see added_name; 0 to 1) of column text, from the text alone. A null or empty
    text is scored as one whose features are all zero."""
    docs = with_string_text(docs)
    bc, name = docs.sparkSession.sparkContext.broadcast(model), added_name(docs)
    return docs.mapInArrow(_score(bc, name), StructType([*docs.schema.fields]).add(name, "double"))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from two thirds of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("y"))
    out = held_out("doc_id", 3, 1)
    model = QualityModel.fit(docs.where(~out), labels.where(~out))
    return quality_scores(docs, model).select("doc_id", out.alias("held_out"), F.col("__quality").alias("score"), (F.col("__quality") >= 0.5).cast("int").alias("predicted"))
