"""From raw documents to packed training sequences, stage by stage; each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgraph.llm.common import own_columns, written
from wardgraph.llm.decontam import clean_documents
from wardgraph.llm.lang_id import UNDETERMINED, LanguageModel, added_names, identify
from wardgraph.llm.near_dup import deduplicated
from wardgraph.llm.packing import packed_pieces
from wardgraph.llm.secrets import SecretModel, redacted_documents, span_name


#: How far the score of a document's language must be from an even share of all languages (0) to certainty (1).
SURE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, sure: float = SURE) -> DataFrame:
    """Documents whose language can be told go on, with the predicted one as lang. Those without a letter go, and those
    whose best language is hardly likelier than the others: with n languages, below 1 / n + sure (1 - 1 / n). The metrics
    `rejected` and `unsure` of the observation `language_id` say how many. Columns of any name pass through."""
    lang, score = added_names(docs)
    model = LanguageModel.fit(docs)
    n = max(len(model.langs), 1)
    told, likely = F.col(lang) != UNDETERMINED, F.col(score) >= 1 / n + sure * (1 - 1 / n) - 1e-9
    found = identify(docs, model).observe("language_id", F.count_if(~(told & likely)).alias("rejected"), F.count_if(told & ~likely).alias("unsure"))
    kept = found.where(told & likely)
    return kept.withColumn("lang", F.col(lang)).select(*own_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8, as near-duplicate stages take where no contract says
    otherwise) the document of the smallest doc_id stays, a document without doc_id coming after all others. Documents
    without words are in no group. Rows that share a doc_id are told apart by their texts; equal ones are one document."""
    return deduplicated(docs, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go. Null and empty texts hold none and stay; repeated rows are judged alike."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; each secret in a text becomes a mark, and n_chars follows. Columns of any name pass through."""
    n = span_name(docs)[1]
    found = redacted_documents(docs, SecretModel.fit(docs))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col(n) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*own_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens. A null text is empty: one piece with the closing
    id alone; each repeated row is packed for itself."""
    return packed_pieces(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secret_scan", secret_scan), ("packing", packing)]

#: Learned models and a tokenizer take part: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what each returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
