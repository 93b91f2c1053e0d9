"""The registered queries of this folder, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from millrace.llm import (
    chat,
    decontamination,
    fill_middle,
    html_text,
    manifest,
    near_duplicates,
    neighbours,
    packing,
    quality,
    repeats,
    sharding,
    token_counts,
    warc,
)
from millrace.llm.common import table
from millrace.session import prepare


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place_documents(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed_bytes(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limited_counts(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify_documents(table(spark, sf_dir, "documents"))


_FUNCTIONS = (
    op1_decontamination,
    op2_neighbours,
    op3_packing,
    op4_warc,
    op5_quality,
    op6_chat,
    op7_sharding,
    op8_near_duplicates,
    op9_repeats,
    op10_html_text,
    op11_fill_middle,
    op12_token_counts,
    op13_manifest,
)

ORACLES = {
    "op1_decontamination": decontamination.SQL,
    "op4_warc": warc.SQL,
    "op6_chat": chat.SQL,
    "op11_fill_middle": fill_middle.SQL,
    "op13_manifest": manifest.SQL,
}


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    return run


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {fn.__name__: _prepared(fn) for fn in _FUNCTIONS} | {"pipeline": _prepared(_pipeline)}
