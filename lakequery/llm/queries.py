"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.substring_dedup import remove_repeats

    return remove_repeats(_docs(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.minmax_dedup import near_duplicates

    return near_duplicates(_docs(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op3_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.hash_tree import assign_shards

    return assign_shards(_docs(spark, sf_dir).select("doc_id", "text")).drop("text")


def op4_simhash_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.simhash_decontam import find_matches

    return find_matches(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.ppm import score_documents

    return score_documents(_docs(spark, sf_dir))


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.language_mixture import identify

    return identify(_docs(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.source_mix import mix_sources

    return mix_sources(_docs(spark, sf_dir).select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op8_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.mcd_quality import judge

    return judge(_docs(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op9_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.disclosure import sanitise

    return sanitise(_docs(spark, sf_dir))


def op10_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lakequery.llm.pfor_tokens import read_tokens, write_tokens

    return read_tokens(write_tokens(_docs(spark, sf_dir), str(public_tokenizers.path("byte_bpe_50k.json"))))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.source_divergence import source_divergence

    return source_divergence(_docs(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.spelling_variants import spelling_groups

    return spelling_groups(_docs(spark, sf_dir))


def op13_ball_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakequery.llm.ball_simhash import ball_components

    return ball_components(_docs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    from lakequery.llm import minmax_dedup, source_divergence, source_mix, spelling_variants, substring_dedup

    return {"op1_substring_dedup": substring_dedup.SQL, "op2_minmax_dedup": minmax_dedup.SQL, "op7_source_mix": source_mix.SQL, "op11_source_divergence": source_divergence.SQL, "op12_spelling_variants": spelling_variants.SQL}
