"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def awkward() -> list[tuple]:
    rng = random.Random(4)
    body = " ".join(words(rng, 90))
    long = " ".join(words(rng, 60_000))
    return [
        (1, body, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \t\n ", "de", None, 4),
        (None, body, "en", "b", 1), (1, body, "en", "a", 1), (5, long, "en", "a", 9), (6, body.replace(" ", "  "), "fr", "b", 1),
        (7, "one", "en", "a", 3), (8, "one", "en", "a", 3), (9, "É ß x \U0001f600", "fr", "c", 5), (10, body + " end", "en", "a", 2),
        (None, None, None, None, None), (11, long + " more", "en", "c", 9),
    ]


def docs(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS)


#: Names that the operators use inside.
CLASHES = ("kept", "rep", "n", "id", "node", "text_sha256", "score", "part", "slot", "size", "a", "b", "u", "v", "key", "mark", "doc",
           "position", "bucket", "count", "weight", "tokens", "shard", "u", "_salt", "component_id", "may_repeat", "wanted", "quality", "topic")


def cluttered(df: DataFrame) -> DataFrame:
    """The same rows with columns of clashing names."""
    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
