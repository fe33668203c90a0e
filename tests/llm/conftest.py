import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(n, t) for n, t in [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]])
#: Names that operators use inside.
CLASHING = ["id", "size", "row", "key", "g", "n", "fp", "rate", "score", "kept", "shard", "cell", "words", "__id", "__n", "__source", "__copies", "component"]


def edge_rows() -> list[tuple]:
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeéß中") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = say(200)
    near = base.split()
    near[77] = "other"
    texts = [None, "", "   ", "\n\t \x0b\x0c\r", "one", "ONE", "a b c", "a b c d", "A B C D", "x y z", say(60), base, base, "  " + base, base.replace(" ", "\n"), " ".join(near), say(30000), "same line here\n" * 40, "#### %% && ||\n" * 20, "le le le le le le", "Ünïcode ÀÉ ß " * 30, "12345 678", "!!! ??? ..."]
    texts += [say(rng.randint(1, 400)) for _ in range(40)]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "s0"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], rows[11], (None, base, None, None, 5), (None, None, None, None, None), (None, "lonely text " * 20, "en", "s1", 5)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge):
    from pyspark.sql import functions as F

    return edge.withColumns({c: F.lit(7) for c in CLASHING})
