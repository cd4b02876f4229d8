"""Small tables with the cases every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

FOLDER = "/root/testdata/sf0.01"
TINY = "/root/testdata/sf0.001"

# Columns that operators use themselves stand beside those of documents.
DOC_DDL = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " id string, score string, fingerprint string, n_words string, shard string, w string"
)
PAGE_DDL = "page_id bigint, url string, html string, id string, host string, text string, row string"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: null, empty, blank, very long, repeated, tied and odd ones."""
    rng = random.Random(3)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    long = words(rng, 60_000, 5_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, base),
        (5, base),
        (6, " ".join(near)),
        (6, " ".join(near)),
        (None, base),
        (None, "lonely words without any number here"),
        (7, long),
        (8, "É é ÀÉÎ straße 漢字 \U0001f600 \x1c odd\x00byte \xa0 space"),
        (9, "one"),
        (10, "one two"),
        (11, "Same Line\nSame Line\n\nsame line\nother"),
        (12, "say " * 50),
        (12, words(rng, 40)),
        (9_007_199_254_740_993, words(rng, 30)),
        (-5, words(rng, 30)),
    ]


def documents(spark: SparkSession, rows=None) -> DataFrame:
    rows = texts() if rows is None else rows
    full = [
        (i, t, "en", "s", None if t is None else len(t), "x", "x", "x", None, "x", "x")
        for i, t in rows
    ]
    return spark.createDataFrame(full, DOC_DDL)


def pages(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PAGE_DDL)
