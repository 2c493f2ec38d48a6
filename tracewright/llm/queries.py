"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.shared import table
from tracewright.llm import mixing, overlap, pii, secrets, tokens, truncation


def _evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stage0_heldout")


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = table(spark, sf_dir, "stage0_corpus").select("row_id", "text", F.lit("stage0_corpus").alias("train_table"), F.col("source_name").alias("train_source"))
    distilled = table(spark, sf_dir, "stage0_distilled").select("row_id", F.col("input").alias("text"), F.lit("stage0_distilled").alias("train_table"), F.col("source.name").alias("train_source"))
    return corpus.unionByName(distilled)


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.same_records(_evaluation(spark, sf_dir), _training(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_pairs(spark, sf_dir).select("eval_row_id", "train_row_id")


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of classes of equal texts with the number of rows on each side, for tables in which copies abound."""
    found, ev, tr = overlap.same_classes(_evaluation(spark, sf_dir), _training(spark, sf_dir))
    rows = lambda members, key, name: members.groupBy(F.col("class_id").alias(key)).agg(F.count("*").alias(name))
    return found.join(rows(ev, "e_id", "eval_rows"), "e_id").join(rows(tr, "t_id", "train_rows"), "t_id")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.by_split_and_source(p1_pairs(spark, sf_dir), _evaluation(spark, sf_dir), _training(spark, sf_dir))


def p1_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.fractions(p1_pairs(spark, sf_dir), _evaluation(spark, sf_dir))


def _coded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "envelope"), table(spark, sf_dir, "stage0_distilled")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_rows(truncation.judged(*_coded(spark, sf_dir)))


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_shares(p3_found(spark, sf_dir), *_coded(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.located(truncation.texts(*_coded(spark, sf_dir))).drop("rule", "checksum")


def p4_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.redacted(truncation.texts(*_coded(spark, sf_dir)))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_ids(table(spark, sf_dir, "documents"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(p7_mix(spark, sf_dir), table(spark, sf_dir, "mix_target"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.mentions(table(spark, sf_dir, "documents"))


def p8_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_placeholders(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_pairs, p1_classes, p1_report, p1_fractions, p3_found, p3_report, p4_found, p4_masked, p6_ids, p7_mix, p7_shares, p8_found, p8_placeholders)}
ORACLES: dict[str, str] = {}
