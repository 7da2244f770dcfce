"""Secret scans: fixed patterns, and character Markov models for what they leave.

The patterns' own hits are the labelled samples: what they capture trains the model of random strings, all other runs
of visible ASCII train the model of ordinary text and identifiers, but those that look like keys. Both are first-order
character models whose counts are taken over all documents. A run of key-like characters outside the pattern hits, of
whatever length, is a secret when the log-likelihood ratio of the two models says so. From which ratio on is a parameter;
`SecretModel.limits` measures what samples of held-out documents would ask for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from wardgraph.llm.common import free_names, with_string_text

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Visible ASCII is 0..93, all else is 94 (which ends a run).
_N, _END = 95, 94
_CODE = np.full(256, _END, np.uint8)
_CODE[0x21:0x7F] = np.arange(94)
_KEY = np.array([chr(c + 0x21).isalnum() or chr(c + 0x21) in "+/_=-" for c in range(94)] + [False])
SPANS = ArrayType(StructType().add("kind", "string").add("start", "integer").add("end", "integer").add("ratio", "double"))
#: Least ratio of a secret, in total and a character: on 0.1 GB of invented prose some two of a million runs have it, most of them random letters.
LEAST, LEAST_MEAN = 20.0, 1.0
#: Ratios of samples are counted in steps of 1 in total and of 1 / 4 a character, up to these.
_TOTALS, _MEANS = 400, 40


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, number of the kind, end, start of the value) of the fixed patterns' hits, in that order."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def _likely(text: str) -> list[tuple[int, int]]:
    """Long key-like runs with a letter and a digit: too often secrets to be samples of ordinary text."""
    return [m.span() for m in _RUN.finditer(text) if any(map(str.isdigit, m.group())) and any(map(str.isalpha, m.group()))]


def _codes(text: str) -> np.ndarray:
    return _CODE[np.frombuffer(text.encode("ascii") if text.isascii() else re.sub(r"[^\x00-\x7f]", " ", text).encode("ascii"), np.uint8)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> a row for each pair of characters that a task has met: label (0 in values, 1 outside), pair, count."""
    n = np.zeros((2, _N * _N), np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            code = _codes(text)
            for start, _, end, value in base_spans(text):
                c = code[value:end].astype(np.int32)
                n[0] += np.bincount(c[:-1] * _N + c[1:], minlength=_N * _N)
                code[start:end] = _END
            for start, end in _likely(text):  # these train neither model
                code[start:end] = _END
            for at in range(0, len(code), 1 << 20):
                c = code[at : at + (1 << 20) + 1].astype(np.int32)
                n[1] += np.bincount(c[:-1] * _N + c[1:], minlength=_N * _N)
    label, pair = np.nonzero(n)
    yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in (label, pair)), pa.array(n[label, pair])], names=["label", "pair", "n"])


def _sample_ratios(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text -> how many samples of each label have a ratio of each step, in total and a character."""
        n = np.zeros((2, _TOTALS + 1, _MEANS + 1), np.int64)

        def count(label: int, total: np.ndarray, size: np.ndarray) -> None:
            np.add.at(n[label], (np.clip(total, 0, _TOTALS).astype(int), np.clip(4 * total / np.maximum(size, 1), 0, _MEANS).astype(int)), 1)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                code = _codes(text or "")
                for start, _, end, value in base_spans(text or ""):
                    starts, ends, total = model.value.ratios(code[value:end])
                    if len(total):
                        best = total.argmax()
                        count(0, total[best : best + 1], (ends - starts)[best : best + 1])
                    code[start:end] = _END
                for start, end in _likely(text or ""):
                    code[start:end] = _END
                starts, ends, total = model.value.ratios(code)
                count(1, total, ends - starts)
        label, total, mean = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in (label, total, mean)), pa.array(n[label, total, mean])], names=["label", "total", "mean", "n"])

    return run


def chosen_limits(n: np.ndarray, false_rate: float, least: int, least_mean: float) -> tuple[float, float, float]:
    """Samples by label, steps of total and of mean -> the limits, at least those given, that find most secrets among those
    that hit at most false_rate of the ordinary runs, of equals the lowest; and the share of secrets that they find (0
    without any). Where no limits are that strict, the strictest."""
    secrets, ordinary = (int(x.sum()) for x in n)
    above = n[:, ::-1, ::-1].cumsum(axis=1).cumsum(axis=2)[:, ::-1, ::-1]  # samples of at least each total and mean
    steps = [(t, m) for t in range(least, _TOTALS) for m in range(int(4 * least_mean), 13)]
    found, t, m = min(((-int(above[0, t, m]), t, m) for t, m in steps if above[1, t, m] <= ordinary * false_rate), default=(-int(above[0, steps[-1][0], steps[-1][1]]), *steps[-1]))
    return float(t), m / 4, -found / max(secrets, 1)


@dataclass
class SecretModel:
    """ratio[a, b]: log-likelihood of b after a as random against ordinary. A run is a secret from `least` in total and
    `least_mean` a character."""

    ratio: np.ndarray
    least: float = LEAST
    least_mean: float = LEAST_MEAN

    def __post_init__(self):
        self.pairs = np.zeros((_N, _N))  # 0 for pairs that are not within a run
        self.pairs[:94, :94] = np.where(_KEY[:94, None] & _KEY[None, :94], self.ratio, 0)
        self.pairs = self.pairs.ravel()

    @classmethod
    def fit(cls, docs: DataFrame, least: float = LEAST, least_mean: float = LEAST_MEAN) -> SecretModel:
        """Counts over all texts; what comes to the driver has at most 2 * 95 * 95 rows. The limits are parameters and the same for
        a table of any size; `limits` says what held-out samples ask for. Without a sample of either kind its model is uniform."""
        return cls(cls._ratio(cls._pairs(docs)), least, least_mean)

    @classmethod
    def limits(cls, docs: DataFrame, false_rate: float = 1e-6, least: float = LEAST, least_mean: float = LEAST_MEAN) -> tuple[float, float, float]:
        """The limits, from those given on, that hit at most false_rate of the ordinary runs of a held-out fifth of the texts (by
        crc32 of the text) and most of its secrets, by models of the other texts; and the share of the secrets they hit."""
        docs = with_string_text(docs)
        held = F.coalesce(F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(5)) == 0, F.lit(False))
        bc = docs.sparkSession.sparkContext.broadcast(cls(cls._ratio(cls._pairs(docs.where(~held)))))
        steps = docs.where(held).select("text").mapInArrow(_sample_ratios(bc), "label int, total int, mean int, n long").groupBy("label", "total", "mean").agg(F.sum("n").alias("n")).collect()
        seen = np.zeros((2, _TOTALS + 1, _MEANS + 1), np.int64)
        for r in steps:
            seen[r.label, r.total, r.mean] = r.n
        return chosen_limits(seen, false_rate, int(least), least_mean)

    @staticmethod
    def _pairs(docs: DataFrame) -> np.ndarray:
        n = np.zeros((2, _N * _N))
        for r in with_string_text(docs).select("text").mapInArrow(_counts, "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
            n[r.label, r.pair] = r.n
        return n

    @staticmethod
    def _ratio(n: np.ndarray) -> np.ndarray:
        """Counts of pairs by label -> log-likelihood ratios."""
        n = n.reshape(2, _N, _N)[:, :94, :94]
        uniform = _KEY[:94] / _KEY.sum()
        # after a character that is rare in its model, that model's characters as such
        single = (n.sum(axis=1) + 0.1) / (n.sum(axis=1) + 0.1).sum(axis=1, keepdims=True)
        smooth = (n + 5 * single[:, None, :]) / (n.sum(axis=2, keepdims=True) + 5)
        secret = 0.5 * smooth[0] + 0.5 * uniform[None, :]  # other key alphabets than the sampled ones stay likely
        return np.log(secret + 1e-9) - np.log(smooth[1])

    def ratios(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and log-likelihood ratios of the key-like runs."""
        edges = np.flatnonzero(np.diff(_KEY[code], prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        llr = np.zeros(len(starts))
        for at in range(0, len(code) - 1, 1 << 20):
            c = code[at : at + (1 << 20) + 1].astype(np.int32)
            v = self.pairs[c[:-1] * _N + c[1:]]
            first, last = max(np.searchsorted(starts, at, "right") - 1, 0), np.searchsorted(starts, at + len(v))
            if first < last:  # a run may have begun before
                llr[first:last] += np.add.reduceat(v, np.maximum(starts[first:last] - at, 0))
        return starts, ends, llr

    def _hits(self, code: np.ndarray) -> Iterator[tuple[int, int, float]]:
        starts, ends, llr = self.ratios(code)
        hit = (llr >= self.least) & (llr >= self.least_mean * (ends - starts))
        return zip(starts[hit].tolist(), ends[hit].tolist(), llr[hit].tolist(), strict=True)

    def _runs(self, code: np.ndarray) -> Iterator[tuple[int, int]]:
        """The key-like runs that are secrets."""
        return ((s, e) for s, e, _ in self._hits(code))

    def scored_spans(self, text: str | None) -> list[tuple[int, int, int, float | None]]:
        """(start, number of the kind, end, ratio), the models' kind being the last and the only one with a ratio; sorted."""
        if not text:
            return []
        base = base_spans(text)
        found: list = [(s, k, e, None) for s, k, e, _ in base]
        code = _codes(text)
        for start, _, end, _ in base:  # of a run that they touch, the parts outside are judged
            code[start:end] = _END
        found += [(start, len(KINDS), end, ratio) for start, end, ratio in self._hits(code)]
        return sorted(found, key=lambda x: x[:3])

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, number of the kind, end), the models' kind being the last; sorted."""
        return [x[:3] for x in self.scored_spans(text)]

    def redact(self, text: str | None, mark: str) -> tuple[str | None, int]:
        """The text with each stretch of its secrets replaced by a mark, and how many secrets there are; in one sweep."""
        spans = self.spans(text)
        parts, at = [], 0
        for start, _, end in spans:
            if start >= at:
                parts += text[at:start], mark
            at = max(at, end)
        return ("".join(parts) + text[at:] if spans else text), len(spans)


def _scan(model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (*KINDS, "markov")
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("ratio", pa.float64())]))
        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = [[{"kind": names[k], "start": s, "end": e, "ratio": r} for s, k, e, r in model.value.scored_spans(t)] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, name])

    return run


def span_name(docs: DataFrame) -> list[str]:
    """Name of the column that secret_spans() and redacted_documents() add: __spans and __secrets, with more underscores
    if docs has such columns."""
    return free_names(docs, "__spans", "__secrets")


def secret_spans(docs: DataFrame, model: SecretModel) -> DataFrame:
    """docs with its columns, and __spans (see span_name): kind, start, end (code points, end exclusive) of each secret of
    text, and the models' log-likelihood ratio where they found it.

    Kinds are those of KINDS and `markov`. A null or empty text has none. Spans are sorted by start, then kind as
    listed; those of different kinds may overlap, the models' overlap no other.
    """
    docs, name = with_string_text(docs), span_name(docs)[0]
    bc = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scan(bc, name), StructType([*docs.schema.fields]).add(name, SPANS))


def _redact(model, name: str, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = [model.value.redact(t, mark) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array([t for t, _ in out], pa.string()), *batch.columns[at + 1 :], pa.array([n for _, n in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    return run


def redacted_documents(docs: DataFrame, model: SecretModel, mark: str = "<SECRET>") -> DataFrame:
    """docs with its columns, each stretch of secrets in text replaced by a mark, and __secrets (see span_name): their
    number. A text without secrets stays as it is."""
    docs, name = with_string_text(docs), span_name(docs)[1]
    bc = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_redact(bc, name, mark), StructType([*docs.schema.fields]).add(name, "long"))


def redacted(text, spans, mark: str = "<SECRET>"):
    """text with each stretch of spans (sorted by start) replaced by a mark: an expression, for a few spans a text;
    redacted_documents() takes time in proportion to the text whatever their number."""
    return F.aggregate(
        spans,
        F.struct(F.lit(1).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"] + 1).alias("at"),
            F.when(s["start"] + 1 >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"], s["start"] + 1 - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"], F.length(text))),
    )


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = secret_spans(docs, SecretModel.fit(docs)).select("doc_id", "__spans")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("__spans", lambda s: s["kind"] != "markov")
    more = (count("markov").alias("n_markov"), F.array_max(F.transform("__spans", lambda s: s["ratio"])).alias("markov_ratio"))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"), *more)
