import random

import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, _key STRING, size STRING, score STRING, row STRING"


def rows(texts):
    return [(i, t, "en", f"s{i % 3}", None if t is None else len(t), "k", "x", "y", "z") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names the operators use themselves."""
    return lambda data: spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    long = " ".join(rng.choice(words) for _ in range(20_000))
    near = long.replace(words[0], words[1], 3)
    data = rows(["", None, "one", "Two words", long, near, "\n\n \t", "ünïcode 世界 \U0001f600 text", long, "to to to to to to"])
    data += [data[2], data[4], (None, "no id", None, None, None, None, None, None, None), (99, None, None, None, None, None, None, None, None)]
    data += [(100, "no id", None, None, None, None, None, None, None), (5, "same id, other text", "en", "s1", 1, None, None, None, None)]
    return data
