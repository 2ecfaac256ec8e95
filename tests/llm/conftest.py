import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        *(T.StructField(c, T.StringType()) for c in ("fp", "component_id", "score", "row", "start", "tokens", "node", "rep", "marks", "sha", "weight", "kind")),
    ]
)
EXTRA = len(DOCS) - 5


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture
def docs_of(spark):
    def make(rows):
        """Documents from (doc_id, text) with columns whose names clash with those inside operators."""
        full = [(i, t, None if k % 3 == 0 else "en", f"s{k % 2}", None if t is None else len(t), *["x"] * EXTRA) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def rng():
    return random.Random(3)
