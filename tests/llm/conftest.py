import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: Columns of other tables' names and of names that operators use inside.
EXTRA = ["n_tokens", "score", "fp", "k", "t", "c", "row_key", "gone", "bucket", "__counts", "line"]
FIELDS = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
DOCS = T.StructType(FIELDS)
WIDE = T.StructType(FIELDS + [T.StructField(c, T.StringType()) for c in EXTRA])


def odd_texts() -> list[str | None]:
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    prose = " ".join(r.choices(words, k=120))
    return [None, "", " \n\t ", "one", "two words", prose, prose, prose + " more", "a\nb\n\nc", "same line of five words\n" * 3,
            "x" * 50_000, " ".join(r.choices(words, k=20_000)), "<|endoftext|> it's <|endoftext|><|endoftext|>x'll ''s\t\n  y",
            "naïve façade 中文 \U0001f600 　z 12½", "mail jo.do.12@mail.example.com or 4111 1111 1111 1111, +1 (743) 555-3824 10.1.2.3 1999-12-31",
            "#*$%&|<> " * 60, "aaa" * 700]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, clashing names."""
    texts = odd_texts()
    rows = [(i, t, "en", "s", 1, *["x"] * len(EXTRA)) for i, t in enumerate(texts)]
    rows += [(None, "null id text of several words here", None, None, None, *[None] * len(EXTRA))] * 2
    rows += [(5, texts[5], "en", "s", 1, *["x"] * len(EXTRA)), (5, "another text under a repeated id", None, None, None, *["y"] * len(EXTRA))]
    return spark.createDataFrame(rows, WIDE).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], WIDE)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
