import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000

ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from it"),  # copy but for capitals
    (2, "the quick brown fox jumps over the lazy dog and runs away from it"),  # repeated row
    (3, ""),
    (4, None),
    (None, "a row without an id"),
    (5, LONG),
    (6, " \t\n "),
    (7, "one two"),
    (8, "One\x0btwo"),
    (9, "x" * 50_000),
    (10, "Café\u00a0crème, naïve ﬁ 日本語 \U0001f600 e\u0301"),
    (11, "Mail me: bob@mail.example.com or 10.1.2.3, card 4111 1111 1111 1111, call +1 (555) 010-9999 now"),
    (12, "Licensed under the MIT\nLicense. Apache License, Version 2.0; CC BY-NC 4.0"),
    (13, None),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names operators use inside."""
    rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in ODD_TEXTS]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("rid", "words", "id", "n", "a", "b", "s", "gram", "shard", "bucket", "label", "score", "item", "h",
                 "blocks", "token", "kind", "row", "key", "_key", "digest", "_digest", "_leaked", "encoded", "Found"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def by_id(df, *columns):
    """Rows as sorted tuples of the columns."""
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()),
                  key=lambda t: tuple((x is not None, str(type(x)), x) for x in t))
