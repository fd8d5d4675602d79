import pytest

from tests.conftest import SF_SMALL

#: Names the operators use inside; inputs may have them too.
CLASHING = ["kept", "words", "key", "unit", "row", "bucket", "shard", "slot", "label", "root", "node", "part",
            "sequence_id", "offset", "base", "_spans", "_clean", "pin", "size", "n", "id", "terms", "item"]

WORDS = "the of and to in alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "on", "ing", "ed", "ly"]) for _ in range(n))


EDGES = [
    (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, prose(1, 60)), (5, prose(2, 80)), (5, prose(2, 80)),
    (6, prose(2, 80)), (7, prose(2, 79) + " changed"), (8, prose(3, 40) + "\n" + prose(3, 40) + "\n"),
    (9, "x" * 3000), (10, prose(4, 30_000)), (11, "émoji 😀 " * 60), (12, prose(5, 30) + " token = \"24be64439e3e49cf46b2d7c90f3602a3\" "
                                                                        + prose(6, 30) + " mail me@example.org or 10.0.0.1"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty, long and repeated texts, with clashing extra columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest tables, as (doc_id, text)."""
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="session")
def results(spark):
    """Rows of a numbered query over the smallest tables."""
    from tidemark.llm import registry

    held = {}

    def run(name):
        if name not in held:
            held[name] = [r.asDict() for r in registry.QUERIES[name](spark, SF_SMALL).collect()]
        return held[name]

    return run
