"""The registered queries of the corpus operators, each over the whole `documents` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from pennyflow.llm import divergence, jaccard, language, licenses, linededup, mixing, pii, prints, quality, sentencepieces, simhash, tokencounts, variants
from pennyflow.llm.common import documents


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return pii.personal_data(documents(spark, sf_dir)).select(
        "doc_id",
        *map(count, ("email", "ip", "card", "phone")),
        F.sha2(text(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labelled = docs.where(F.col("doc_id").isNotNull() & ~language.in_test_fold(F.col("doc_id")))
    found = language.predicted(docs, language.fitted(labelled))
    return found.select("doc_id", language.in_test_fold(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), words=3, bits=64, threshold=3)
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, plan = mixing.mix(documents(spark, sf_dir), F.array("source"))
    rows = rows.withColumn("source", F.col("sources")[0])
    # One row per source; mix() bounds their number.
    plan = F.broadcast(plan.withColumnRenamed("source", "of"))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prints.edited_prints(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.counted(documents(spark, sf_dir))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encoded(documents(spark, sf_dir))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir), wrapped=True)
    base = F.transform("places", lambda p: p["label"])
    n = F.size("places")
    return found.select(
        "doc_id",
        "n_words",
        n.cast("bigint").alias("n_base"),
        F.get("places", F.lit(0))["start"].cast("bigint").alias("first_word"),
        F.get("places", n - 1)["start"].cast("bigint").alias("last_word"),
        licenses.label_list(base).alias("base_labels"),
        licenses.label_list(F.concat(base, F.col("met"))).alias("labels"),
        F.when(n > 0, 1.0).otherwise(F.col("containment")).alias("score"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measured(documents(spark, sf_dir))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(documents(spark, sf_dir))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(documents(spark, sf_dir))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_simhash": op3_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_fingerprints": op6_fingerprints,
    "op7_token_counts": op7_token_counts,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_variants": op11_variants,
    "op12_jaccard": op12_jaccard,
    "op13_divergence": op13_divergence,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op4_line_dedup": linededup.SQL,
    "op5_mixing": mixing.SQL,
    "op9_licenses": licenses.SQL,
    "op12_jaccard": jaccard.SQL,
    "op13_divergence": divergence.SQL,
}
