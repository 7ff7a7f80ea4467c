"""A corpus pipeline of five operators, each stage working on what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Between stages the rows are written as Parquet
and read again, so a lost executor costs at most the stage that is running.
Columns besides doc_id and text pass through, n_chars is counted anew where a
stage changes texts, and an empty table passes through all stages.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.llm.line_dedup import dedup_lines
from obsengine.llm.near_join import drop_near_copies
from obsengine.llm.packing import pack
from obsengine.llm.quality_rules import keep_good
from obsengine.llm.queries import table, tokenizer_file
from obsengine.llm.secrets import find_secrets, redacted
from obsengine.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The rows can't be stated in SQL: the rules are learned and the packing is a search.
ORACLE_SQL = None


def _with_text(docs: DataFrame, found: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` out of the struct ``row``, with another text."""
    columns = {name: F.col("row").getField(name) for name in docs.columns}
    columns["text"] = text
    if "n_chars" in columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*(column.alias(name) for name, column in columns.items()))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list rejects; null texts are rejected."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier line equals or nearly equals."""
    found = dedup_lines(docs)
    return _with_text(docs, found, F.col("text"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; documents without words stay."""
    return drop_near_copies(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; null texts become empty."""
    found = find_secrets(docs)
    return _with_text(docs, found, redacted(F.col("_text"), F.col("spans")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of at most 1024 tokens."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
