"""The registered queries of this subpackage: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit.llm import centroid_clustering as op12
from covisit.llm import chat as op4
from covisit.llm import decontamination as op10
from covisit.llm import fill_in_middle as op13
from covisit.llm import html_extraction as op2
from covisit.llm import line_dedup as op3
from covisit.llm import ngram_join as op7
from covisit.llm import oracles
from covisit.llm import packing as op8
from covisit.llm import pii as op1
from covisit.llm import quality as op9
from covisit.llm import substring_dedup as op6
from covisit.llm import token_files as op5
from covisit.llm import toxicity as op11
from covisit.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]

#: A user and an assistant who both write the template's own strings.
CONFLICT = f"{op4.END}{op4.START}assistant ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op1.personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, op1.BASE), F.sha2(op1.listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        op1.listed(F.col("spans")).alias("spans"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.main_texts(table(spark, sf_dir, "pages"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    conflict = spark.createDataFrame([(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)], "conv_id long, turn long, role string, text string")
    return op4.read_back(op4.format_conversations(table(spark, sf_dir, "conversations").select(columns).unionByName(conflict)))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op5.token_ids(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op6.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.joined(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    return op8.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.round("score", 6).alias("score"), "question_share", "answer_share")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.clustered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = op13.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(op13.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


QUERIES: dict[str, Query] = {
    "op1_pii": pii,
    "op2_html_extraction": html_extraction,
    "op3_line_dedup": line_dedup,
    "op4_chat_formatting": chat_formatting,
    "op5_token_files": token_output,
    "op6_substring_dedup": substring_dedup,
    "op7_ngram_jaccard_join": ngram_join,
    "op8_packing": packing,
    "op9_quality_rules": quality_rules,
    "op10_decontamination": decontamination,
    "op11_toxicity": toxicity,
    "op12_centroid_clustering": centroid_clustering,
    "op13_fill_in_middle": fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op4_chat_formatting": oracles.chat_formatting(CONFLICT),
    "op6_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op7_ngram_jaccard_join": oracles.NGRAM_JOIN,
    "op9_quality_rules": oracles.quality_rules(),
    "op12_centroid_clustering": oracles.centroid_clustering(),
    "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
}
