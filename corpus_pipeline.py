"""A training corpus from raw documents: language, near copies, benchmark leaks, mix, token files.

Each stage works on all that the one before it kept; its result is written to the shared folder and read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proplens.llm import language_id, mixing, simhash, token_output
from proplens.llm.common import written
from proplens.llm.decontaminate import decontaminate

#: Below this pooled probability a document's language counts as not recognised.
MIN_SCORE = 0.3


def _row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a null text, and one without a letter, has none."""
    rest = docs.drop("text")
    found = language_id.identify(docs, *language_id.fit(docs), extra=(_row(rest),), with_text=True)
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.select(*[F.col("lid_text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest identifier, of each group of linked fingerprints."""
    return simhash.one_of_each(docs, shingle=3, distance=2)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words of a benchmark item in a row."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items, window=10, k=5, extra=(_row(docs),)).filter(~F.col("contaminated")).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    mixed = mixing.mix_sources(docs, weights=(3, 1, 2), share=1.5, cap=2.0, extra=(_row(docs),))
    return mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents: doc_id, start, n_tokens, ids_crc32."""
    return token_output.token_output(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark_leaks", benchmark_leaks), ("mix", mix),
          ("tokens", tokens)]

#: Fingerprints, a network and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
