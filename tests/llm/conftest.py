from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The tests' own shared folder, and the package on the workers."""
    from ludolake.llm.common import ship_code

    ship_code(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (doc_id, text) pairs."""
    def make(rows, lang="en"):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    def table(name):
        return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")

    return table


@pytest.fixture(scope="session")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


ODD_TEXTS = [None, "", " \t\n", "one", "one", "\x00 é x", "a" * 5000, "word " * 30_000, "🙂 👩‍👩‍👧 <|endoftext|> é"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, repeated rows, odd and long texts, and columns whose names clash with the operators' own."""
    rows = [(i if i != 3 else None, t, None if i % 2 else "en", None, None) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame(rows + rows[:3], DOCS)
    for name in ("node", "score", "s", "votes", "label", "length", "a", "doc", "kept"):
        df = df.withColumn(name, df.doc_id)
    return df
