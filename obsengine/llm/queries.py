"""Registered queries of this subpackage and their SQL, where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.llm.common import SPACE_RUN
from obsengine.llm.divergence import divergence_sql
from obsengine.llm.line_dedup import dedup_sql
from obsengine.llm.near_join import near_join_sql
from obsengine.llm.secrets import scan_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A file of the public tokenizers, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.quality_rules import quality_rules

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm import secrets as s

    found = s.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = len(s.BASE)
    count = lambda n: F.size(F.filter("spans", lambda x: x["kind"] == n)).cast("long")
    first = F.filter("spans", lambda x: x["kind"] < base)
    return found.select(
        "row.doc_id",
        *(count(n).alias(f"n_{kind}") for n, kind in enumerate(s.BASE)),
        F.sha2(s.spelled(first), 256).alias("base_sha256"),
        s.spelled(F.col("spans")).alias("spans"),
    )


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.near_join import near_join

    return near_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return out.select("row.doc_id", "n_lines", "n_exact", "n_near", digest)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.token_files import read_ids, write_ids
    from obsengine.session import scratch_path

    folder = scratch_path(spark, "token-files")
    write_ids(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), folder)
    return read_ids(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.sentence_pieces import encode_pieces

    found = encode_pieces(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("begins", "ends").alias("spans_hash"),
    )


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.rule_ensemble import classify

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels"))


def op9_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.multi_index import nearest

    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.token_counts import token_count

    count, text = token_count(tokenizer_file("byte_bpe_50k.json")), F.col("text")
    counted = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        count(text).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text), every text whose id's checksum is divisible by 10 made periodic from one word on."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", SPACE_RUN), "")
    # Without functions of elements: Spark can't hand their results to Python.
    steps = {
        "words": F.when(checksum % 10 == 0, words),
        "g": F.call_function("div", checksum, F.lit(10)),
    }
    docs = docs.withColumns(steps).withColumn("n", F.size("words"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    docs = docs.withColumn("p", (F.call_function("div", F.col("n") - F.col("a"), 3 + F.col("g") % 8) + 1).cast("int"))
    tail = F.col("n") - F.col("a")
    rounds = F.ceil(tail / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), rounds))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), tail)), " ")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsengine.llm.periodic_runs import periodic_runs

    docs = _with_planted_period(table(spark, sf_dir, "documents"))
    runs = F.col("found.runs")
    # Longest first, then by start and period.
    longest = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
    return (
        docs.select("doc_id", periodic_runs()("text").alias("found"))
        .withColumn("longest", longest)
        .select(
            "doc_id",
            F.size(runs).cast("long").alias("n_runs"),
            F.col("longest.s").alias("start"),
            (-F.col("longest.l")).alias("length"),
            F.col("longest.p").alias("period"),
            F.call_function("div", -1000 * F.col("longest.l"), F.col("longest.p")).alias("exponent_milli"),
            F.sha2(lines, 256).alias("runs_sha256"),
            F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
        )
    )


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op4_secret_scans": op4_secret_scans,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op5_line_dedup": op5_line_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op10_token_files": op10_token_files,
    "op8_sentence_pieces": op8_sentence_pieces,
    "op6_rule_ensemble": op6_rule_ensemble,
    "op9_recurrent_lm": op9_recurrent_lm,
    "op2_multi_index": op2_multi_index,
    "op11_token_counts": op11_token_counts,
    "op12_source_divergence": op12_source_divergence,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op4_secret_scans": scan_sql(),
    "op5_line_dedup": dedup_sql(),
    "op7_ngram_jaccard_join": near_join_sql(),
    "op12_source_divergence": divergence_sql(),
}
