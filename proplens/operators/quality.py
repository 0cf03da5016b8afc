"""Data-quality gates as rows: (rule, dataset, column, violations).

Every rule of a dataset is evaluated in ONE aggregate scan; ``assert_valid``
raises when any rule has violations.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proplens.functions.names import col
from pyspark.sql import types as T

from proplens.operators.clean import NUMERIC_TYPES, is_missing


class DataQualityError(ValueError):
    pass


def _rule(name, column, violations):
    return F.struct(F.lit(name).alias("rule"), F.lit(column).cast("string").alias("column"),
                    violations.cast("long").alias("violations"))


def quality_rules(df: DataFrame, dataset: str, required: Sequence[str] = (), target: str | None = None,
                  predictors: Sequence[str] | None = None) -> DataFrame:
    """Rules: required columns present, not empty, no missing target/predictors, no ±Inf."""
    spark = df.sparkSession
    have = set(df.columns)
    preds = [c for c in (predictors if predictors is not None else df.columns) if c in have and c != target]
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    if target and target in have:
        aggs.append(F.count_if(is_missing(df, target)).alias("_t"))
    aggs += [F.count_if(is_missing(df, c)).alias(f"_p{i}") for i, c in enumerate(preds)]
    aggs += [F.count_if(F.abs(col(c)) == F.lit(float("inf"))).alias(f"_i{i}") for i, c in enumerate(dbl)]
    one = df.agg(*aggs)
    items = [F.struct(F.lit("not_empty").alias("rule"), F.lit(None).cast("string").alias("column"),
                      F.when(F.col("_rows") == 0, 1).otherwise(0).cast("long").alias("violations"))]
    if target and target in have:
        items.append(_rule("target_not_missing", target, F.col("_t")))
    items += [_rule("predictor_not_missing", c, F.col(f"_p{i}")) for i, c in enumerate(preds)]
    items += [_rule("finite_values", c, F.col(f"_i{i}")) for i, c in enumerate(dbl)]
    rows = one.select(F.explode(F.array(*items)).alias("_s")).select(
        F.col("_s.rule").alias("rule"), F.lit(dataset).alias("dataset"),
        F.col("_s.column").alias("column"), F.col("_s.violations").alias("violations"))
    missing = [c for c in required if c not in have]
    req = spark.createDataFrame([("required_columns", dataset, c, 1) for c in missing] or
                                [("required_columns", dataset, None, 0)],
                                "rule string, dataset string, column string, violations long")
    return req.unionByName(rows)


def schema_violations(train: DataFrame, test: DataFrame | None = None) -> list[str]:
    """Driver-side schema rules: duplicate names, non-numeric predictors, train/test columns equal."""
    out = []
    for name, d in (("train", train), ("test", test)):
        if d is None:
            continue
        dup = [c for c, n in Counter(d.columns).items() if n > 1]
        if dup:
            out.append(f"{name}: duplicate columns {dup}")
        bad = [f.name for f in d.schema.fields
               if not isinstance(f.dataType, (*NUMERIC_TYPES, T.BooleanType))]
        if bad:
            out.append(f"{name}: non-numeric columns {bad}")
    if test is not None and list(train.columns) != list(test.columns):
        out.append("train and test columns differ")
    return out


def assert_valid(rules: DataFrame, schema_problems: Sequence[str] = ()) -> None:
    """Raise ``DataQualityError`` naming every rule with violations (at most one row per rule and column is read)."""
    bad = rules.where(F.col("violations") > 0).collect()
    if bad or schema_problems:
        msgs = [f"{r['dataset']}.{r['column']}: {r['rule']} ({r['violations']})" for r in bad]
        raise DataQualityError("; ".join([*schema_problems, *msgs]))


def empty_dataset_check(spark: SparkSession, df: DataFrame) -> bool:
    return df.isEmpty()
