"""Queries over the language-model operators: name -> (Spark callable, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lurewatch import ship
from lurewatch.llm import (
    bpe_codec, decontaminate, exact_dedup, html_consensus, jaccard_join, language, phrases, pitman_yor, quality, resample,
    token_counts, token_store, url_filter,
)
from lurewatch.llm.common import table

#: Vocabulary file of the token operators; it must lie at the same place on every executor.
VOCABULARY = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = (run, sql)
        return fn

    return add


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@register("op1_pitman_yor")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"))


@register("op2_token_store")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, vocabulary_path())
    return token_store.read_records(token_store.look_up(docs, store), store)


@register("op3_bpe_round_trip")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


@register("op4_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


@register("op5_exact_dedup", exact_dedup.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@register("op6_url_rules", url_filter.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@register("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_classifier(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model)


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


@register("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op10_html_consensus")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.extract_pages(table(spark, sf_dir, "pages"))


@register("op11_phrases", phrases.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@register("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict_languages(docs, language.fit_languages(docs))


@register("op13_resample", resample.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
