"""Exact dedup by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition makes a run: its distinct digests in order, each with the identifier that stays and the number of
copies.  Runs then meet in rounds; in each round ``fan_in`` neighbouring runs (``log2(fan_in)`` binomial rounds at once)
exchange rows by digest and merge, so that every level moves each digest of a run once at most and a text with millions
of copies shrinks to one row a run before it first travels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proplens.llm.common import written

#: An entry of a run is the same text only if all three agree: a run never joins two texts on one digest alone.
KEY = ["digest", "check_hash", "n_bytes"]


def digest_rows(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    """One narrow row per document: identifier, verified key, run and a row number that stays as written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.xxhash64(text).alias("check_hash"), F.octet_length(text).alias("n_bytes"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"), F.monotonically_increasing_id().alias("row"))


def merge_runs(rows: DataFrame, keep: str, runs: int, fan_in: int) -> DataFrame:
    """The tree: level 0 sorts and combines within each run, every further level merges ``fan_in`` runs."""
    best = F.max if keep == "max" else F.min
    known = F.col("doc_id").isNotNull() if keep == "max" else F.col("doc_id").isNull()
    level = rows.groupBy("run", *KEY).agg(
        best(F.struct(known.alias("known"), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    while runs > 1:
        runs = -(-runs // fan_in)
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).groupBy("run", *KEY).agg(
            best("best").alias("best"), F.sum("group_size").alias("group_size"))
    return level


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                runs: int = 64, fan_in: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical byte for byte; null counts as the empty text, which is a text like any other.  Of
    equal texts the row with the smallest (``keep="min"``) or largest (``"max"``) identifier stays; a null identifier
    loses to any other.  Exactly one row of a group has ``kept``, also where rows repeat with the same identifier.
    Other columns are not read.  An empty table gives no rows.
    """
    if keep not in ("min", "max") or runs < 1 or fan_in < 2:
        raise ValueError("keep is min or max, runs at least 1, fan_in at least 2")
    rows = written(digest_rows(docs, id_col, text_col, runs), "digests")
    groups = merge_runs(rows, keep, runs, fan_in).filter("group_size > 1").select(*KEY, "best", "group_size")
    single = F.col("group_size").isNull()
    return rows.join(groups, KEY, "left").select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
