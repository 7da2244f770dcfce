"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts is the mean, over n-gram lengths, of the number of n-grams (hashed
into 2 ** 16 buckets a length) that both have over the geometric mean of their numbers. Landmark texts span the Nyström
space, and one-versus-rest kernel ridge regression is fitted there. Kernels with landmarks and their weighted sums are
both linear in the normalised presence, so the landmarks' product with the weights is formed once, and batches of texts
are scored by a product of presence with it: the model's size depends on buckets and languages, not on landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgraph.llm.common import free_names, held_out, text_key, with_string_text
from wardgraph.llm.tokens import forget

LENGTHS, BUCKETS = (1, 2, 3), 1 << 16
#: Buckets of a block when kernels are formed.
_COLUMNS = 8192
UNDETERMINED = "und"


def _marks(text: str, marks: np.ndarray) -> np.ndarray:
    """Sets the text's buckets in marks, and returns them with repeats."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    h, out = np.zeros(len(code), np.uint32), []
    for i, n in enumerate(LENGTHS):
        if len(code) < n:
            break
        h = h[: len(code) - n + 1] * np.uint32(0x01000193) + (code[n - 1 :] + np.uint32(1)) * np.uint32(0x9E3779B1)
        out.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(16)) + np.uint32(i * BUCKETS))
    found = np.concatenate(out) if out else np.empty(0, np.uint32)
    marks[found] = True
    return found


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text -> lang, the text's buckets: 3 * 2 ** 16 at most, however long the text."""
    marks = np.zeros(len(LENGTHS) * BUCKETS, bool)
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            found = _marks(text, marks)
            out.append(np.flatnonzero(marks).astype(np.int32))
            marks[found] = False
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["lang", "buckets"])


@dataclass
class LanguageModel:
    langs: list[str]
    vocab: np.ndarray  # buckets of the landmarks
    weights: np.ndarray  # vocab x langs: landmarks (normalised presence / number of lengths) times their weights
    sharpness: float = 6.0

    @classmethod
    def fit(cls, docs: DataFrame, per_lang: int = 250, landmarks_per_lang: int = 50, ridge: float = 1e-3, most: int = 10_000, most_landmarks: int = 1_000) -> LanguageModel:
        """docs: text, lang, doc_id. Of each language the per_lang texts whose doc_id and text hash lowest are learned
        from, equal ones once, and the first landmarks_per_lang of them are landmarks; with many languages fewer, so that
        there are at most `most` texts and most_landmarks landmarks in all, or one a language. Rows without lang or letters
        are left out. The driver gets the buckets of those texts alone; kernels are formed in blocks of buckets and texts."""
        docs = with_string_text(docs).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
        rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", text_key().alias("key"))
        order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "key"), "doc_id", "key")
        ids = rows.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_lang)
        n_langs = max(1, ids.select("lang").distinct().count())
        ids = ids.where(F.col("n") <= max(1, min(per_lang, most // n_langs))).select(F.col("doc_id").alias("i"), F.col("lang").alias("l"), F.col("key").alias("k"))
        on = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("lang") == F.col("l")) & (text_key() == F.col("k"))
        chosen = docs.join(F.broadcast(ids), on).dropDuplicates(["doc_id", "lang", "k"]).select("lang", "text")
        found = sorted(((r.lang, sorted(r.buckets)) for r in chosen.mapInArrow(_presence, "lang string, buckets array<int>").collect()), key=lambda x: (x[0], hash(tuple(x[1])), len(x[1])))
        langs = sorted({lang for lang, _ in found})
        if not langs:
            return cls([], np.empty(0, np.int64), np.empty((0, 0), np.float32))
        data = [np.array(b, np.int64) for _, b in found]
        marks, first, each = [], dict.fromkeys(langs, 0), max(1, min(landmarks_per_lang, most_landmarks // len(langs)))
        for (lang, _), buckets in zip(found, data, strict=True):
            if first[lang] < each:
                first[lang] += 1
                marks.append(buckets)
        vocab = np.unique(np.concatenate(marks))
        y = np.where(np.array([lang for lang, _ in found])[:, None] == np.array(langs)[None, :], 1.0, -1.0)
        kmm, right, left = cls._kernels(marks, marks, vocab), np.zeros((len(marks), len(langs))), np.zeros((len(marks), len(marks)))
        for at in range(0, len(data), 2048):
            knm = cls._kernels(data[at : at + 2048], marks, vocab)
            left += knm.T @ knm
            right += knm.T @ y[at : at + 2048]
        # Nyström: the ridge penalty is the norm in the landmarks' space
        alpha = np.linalg.solve(left + ridge * len(found) * kmm + 1e-8 * np.eye(len(kmm)), right)
        weights = np.zeros((len(vocab), len(langs)))
        for at in range(0, len(vocab), _COLUMNS):
            part = vocab[at : at + _COLUMNS]
            weights[at : at + _COLUMNS] = np.stack([cls._row(m, part) for m in marks]).T @ alpha / len(LENGTHS)
        return cls(langs, vocab, weights.astype(np.float32))

    @classmethod
    def _kernels(cls, a: list[np.ndarray], b: list[np.ndarray], vocab: np.ndarray) -> np.ndarray:
        """The blended presence kernel of two lists of bucket sets, over the buckets of vocab; summed up over blocks of it."""
        out = np.zeros((len(a), len(b)))
        for at in range(0, len(vocab), _COLUMNS):
            part = vocab[at : at + _COLUMNS]
            out += np.stack([cls._row(x, part) for x in a]) @ np.stack([cls._row(x, part) for x in b]).T
        return out / len(LENGTHS)

    @staticmethod
    def _row(buckets: np.ndarray, vocab: np.ndarray) -> np.ndarray:
        at = np.searchsorted(vocab, buckets)
        ok = at < len(vocab)
        hit = at[ok][vocab[at[ok]] == buckets[ok]]
        row = np.zeros(len(vocab), np.float32)
        row[hit] = 1
        n = np.bincount(buckets // BUCKETS, minlength=len(LENGTHS))
        return row / np.sqrt(np.maximum(n, 1)).astype(np.float32)[vocab // BUCKETS]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score (a softmax of the regressions' values) of each text; `und` and 0 without a letter, or if
        nothing was learned."""
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        marks, part = np.zeros(len(LENGTHS) * BUCKETS, bool), self.vocab // BUCKETS
        for at in range(0, len(known), 256):
            some = known[at : at + 256]
            x, root = np.empty((len(some), len(self.vocab)), np.float32), np.empty((len(some), len(LENGTHS)), np.float32)
            for j, i in enumerate(some):
                found = _marks(texts[i], marks)
                x[j] = marks[self.vocab]
                root[j] = [np.count_nonzero(marks[n * BUCKETS : (n + 1) * BUCKETS]) for n in range(len(LENGTHS))]
                marks[found] = False
            x /= np.sqrt(np.maximum(root, 1))[:, part]
            f = x @ self.weights
            e = np.exp(self.sharpness * (f - f.max(axis=1, keepdims=True)))
            p = e / e.sum(axis=1, keepdims=True)
            for i, best, row in zip(some, p.argmax(axis=1), p, strict=True):
                langs[i], scores[i] = self.langs[best], float(row[best])
        return langs, scores


def _predict(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # what earlier stages left in this worker
        for batch in batches:
            langs, scores = model.value.predict(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, *names])

    return run


def added_names(docs: DataFrame) -> list[str]:
    """Names of the columns that identify() adds: __lang and __score, with more underscores if docs has such columns."""
    return free_names(docs, "__lang", "__score")


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs with its columns, and __lang and __score (see added_names) of column text; other columns have no part in it.

    A null or empty text, or one without a letter, is `und` with score 0; so is every text if no language was learned.
    """
    docs = with_string_text(docs)
    bc, names = docs.sparkSession.sparkContext.broadcast(model), added_names(docs)
    return docs.mapInArrow(_predict(bc, names), StructType([*docs.schema.fields]).add(names[0], "string").add(names[1], "double"))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = LanguageModel.fit(docs.where(~held_out("doc_id", 5, 0)))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
