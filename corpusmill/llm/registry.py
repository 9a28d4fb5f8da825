"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import binary_ids, bpe_sql, exact_dedup, html_text, lattice_lm, line_templates, near_dup, packing, quality, token_counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_templates(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir), digest_all=True)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op7_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = binary_ids.id_files_path(spark, "ids")
    binary_ids.write_ids(documents(spark, sf_dir), path)
    return binary_ids.read_ids(spark, path)


def op8_bpe_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_sql.encode_and_decode(documents(spark, sf_dir))


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(documents(spark, sf_dir))


def op10_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_classes(documents(spark, sf_dir))


QUERIES = (
    op1_line_dedup,
    op2_token_counts,
    op3_packing,
    op4_exact_dedup,
    op5_html_text,
    op6_quality_rules,
    op7_binary_ids,
    op8_bpe_sql,
    op9_lattice_lm,
    op10_near_join,
)
ORACLES = {"op1_line_dedup": line_templates.ORACLE, "op4_exact_dedup": exact_dedup.ORACLE, "op6_quality_rules": quality.ORACLE, "op10_near_join": near_dup.ORACLE}


def queries() -> dict:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
