"""Registered queries of this subpackage: thin digests over the operators, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import bpe, collocations, decontaminate, fim, html_main, lattice_lm, line_dedup, near_dup, pii, quality, secrets_rf, token_counts, token_store
from farelane.llm.frames import read_table
from farelane.llm.paths import tokenizer_path, unigram_path


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"), keep_text=False)
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_rf.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "start", "end", F.sha2("token", 256).alias("token_sha256"), "probability", "is_secret")


def q_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def q_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"), unigram_path())


def q_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_main.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, tokenizer_path()).drop("text")
    both = bpe.decode(coded, tokenizer_path())
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("text")
    lengths = token_counts.token_lengths(docs, tokenizer_path()).select("n_tokens")
    return token_counts.context_totals(token_counts.length_histogram(lengths))


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_dedup.line_report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return report.select("doc_id", "n_lines", "n_removed", F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_failed_lines", "lost_chars"
    )


def q_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_store.write_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return token_store.read_documents(files, with_ids=False)


def q_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fim.digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def q_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


def queries() -> dict:
    return {
        "op1_decontaminate": q_decontaminate,
        "op2_pii": q_pii,
        "op3_secrets": q_secrets,
        "op4_near_dup": q_near_dup,
        "op5_lattice_lm": q_lattice_lm,
        "op6_html": q_html,
        "op7_bpe": q_bpe,
        "op8_token_counts": q_token_counts,
        "op9_line_dedup": q_line_dedup,
        "op10_quality_rules": q_quality,
        "op11_token_store": q_token_store,
        "op12_fim": q_fim,
        "op13_collocations": q_collocations,
        "pipeline": corpus_pipeline.run,
    }


def oracles() -> dict[str, str]:
    sql = {"op12_fim": fim.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
