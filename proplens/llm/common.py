"""Helpers shared by the operators: text rules, keys of texts, written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proplens.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What lies between words: ASCII white space; any ASCII character but letters and digits.  The words themselves, for SQL.
SPACES = r"[\x20\x09-\x0D]+"
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only.  Pure ASCII texts take the built-in byte path, which is the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def words_between(text: Column, gaps: str) -> Column:
    """Array of a text's words; null has none.  Splitting at the gaps costs a sixth of extracting the words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gaps), "")


def plain_words(text: Column) -> Column:
    """Array of the lower-cased plain words of a text; null has none."""
    return words_between(lower_ascii(text), GAPS)


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a text in joins."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that the session names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/proplens-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: its lineage ends there."""
    path = scratch_uri(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(frame: DataFrame) -> None:
    """Deletes the files of a frame from ``written`` that no later step reads."""
    spark = frame.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
