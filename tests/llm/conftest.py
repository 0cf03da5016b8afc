import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside; a table may have them too.
CLASHES = ["k1", "k2", "h", "fp", "run", "row", "point", "size", "digest", "words", "hash", "start", "n", "copies", "arc",
           "best", "group_size", "component", "spans", "prints", "row_id", "lid_text", "a.b"]


def add_clashes(df):
    for c in CLASHES:
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def sf_docs(spark):
    """sf0.001 documents as (doc_id, text, lang, source) rows."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text", "lang", "source").collect()]


@pytest.fixture(scope="session")
def edge_docs():
    """Nulls in every column, empty and long texts, ties, repeated rows and identifiers."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    long = " ".join(rng.choice(words) for _ in range(4000))
    base = " ".join(rng.choice(words) for _ in range(130))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "  \n\t ", "de", "a"), (4, long, "en", "a"),
            (5, base, "en", "b"), (6, base, "en", "b"), (6, base, "en", "b"), (6, base + " more", None, None),
            (None, base, "de", "b"), (None, None, None, None), (7, "x " + base + " y", "en", None),
            (8, "Same same SAME same " * 60, "fr", "c"), (9, "same same same same " * 60, "fr", "c"),
            (10, "Übung \u00a0 ÉCOLE 12\u2003x\x1cy", "de", "é"), (11, "short text", "en", "a"),
            (12, long[:9000], "en", "a"), (13, base.upper(), "en", "a"), (14, "12 34 !!", "en", "z")]
    return rows + [(100 + i, base.replace("w7 ", f"w{i} "), "en", "b") for i in range(30)]


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, clashes=True):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return add_clashes(df.repartition(3) if rows else df) if clashes else df
    return make
