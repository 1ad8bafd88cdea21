import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string"


def prose(g, n):
    return " ".join("".join(g.choice(["an", "to", "re", "li", "mo", "sé"]) for _ in range(g.randint(1, 4))) for _ in range(n))


def edge_rows():
    """Nulls, empty and very long texts, repeated rows, ties, copies near and exact, and columns whose names operators use."""
    g = random.Random(5)
    a, b = prose(g, 120), prose(g, 400)
    near = a.split()
    near[60] = "changed"
    rows = [(1, a, "en", "s1"), (2, a, "en", "s2"), (3, " ".join(near), "en", "s1"), (4, b, None, None), (5, None, "en", "s1"), (6, "", "en", "s2"), (7, "", "en", "s2"), (None, a, "en", "s3"), (8, "  \n ", "fr", "s3"), (9, "one two", "de", "s1"), (10, "One, two!", "de", "s1"), (11, prose(g, 9000), "en", "s2"), (12, "x" * 40_000, "en", "s2"), (4, b, None, None), (13, "a  b \n\n c d <|endoftext|> it's 12345 你好 \x1c é ", "en", "s1"), (14, None, None, "s1")]
    rows += [(20 + i, prose(g, 60), "en", f"s{i % 3}") for i in range(20)]
    return [(*r, 0, "clash", "clash") for r in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
