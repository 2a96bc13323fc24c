"""Small tables with nulls, empty and long texts, ties, repeats and clashing extra columns."""
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

WORDS = [a + b for a in ("ka", "to", "mi", "su", "re", "lo", "na") for b in ("ra", "ni", "po", "de", "vu", "s", "l")]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n))


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for themselves
    T.StructField("row", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("print", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("id", T.StringType()), T.StructField("rank", T.StringType()),
    T.StructField("length", T.StringType()), T.StructField("left", T.StringType())])


def frame(spark, rows):
    """Documents from ``(doc_id, text)``."""
    return spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t), "x", "y", 1, 0.5, "i", "r", "l", "f") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    passage = prose(99, 70)
    long = prose(7, 30_000)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One"), (6, prose(1, 80)), (7, prose(1, 80)),
        (8, prose(1, 80)), (9, prose(2, 60) + " " + passage + " " + prose(3, 60)),
        (10, prose(4, 55) + "\n" + passage + "\n" + prose(5, 20)), (11, "naïve “quotes” — 漢字 𝔘𝔫𝔦 é́ 🙂 <|endoftext|> x  y \n z "),
        (12, long), (13, long), (14, "la " * 400), (None, prose(6, 90)), (None, None), (15, prose(8, 60)), (15, prose(8, 60)),
        (16, "a\x0bb\x0cc\x1cd\x85e\xa0f")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])


def rows_of(df) -> list[Row]:
    return sorted(df.collect(), key=repr)
