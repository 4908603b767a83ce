from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy int, h string, id string, rule string"


def awkward_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    words = ["the", "of", "Alpha", "beta", "gamma", "DELTA", "straße", "niño", "été", "x1", "###", "日本語", "😀"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(120)
    rows = [
        (1, None, "en", "src1", None, 1, "a", "i", None),
        (2, "", "en", "src1", 0, None, None, None, "r"),
        (3, " \n\t \n", None, None, 5, 1, "a", "i", "r"),
        (None, text(40), "de", "src2", 9, 1, "a", "i", "r"),
        (None, None, None, None, None, None, None, None, None),
        (4, base, "en", "src1", 1, 1, "a", "i", "r"),
        (4, base, "en", "src1", 1, 1, "a", "i", "r"),
        (5, base.upper(), "en", "src2", 1, 1, "a", "i", "r"),
        (6, base + " tail end", "fr", "src3", 1, 1, "a", "i", "r"),
        (7, "x" * 60_000, "en", "src1", 1, 1, "a", "i", "r"),
        (8, text(9000), "xx", "src4", 1, 1, "a", "i", "r"),
        (9, "same line here\nown line " + text(5), "en", "src1", 1, 1, "a", "i", "r"),
        (10, "same line here\n" + text(30), "en", "src2", 1, 1, "a", "i", "r"),
        (11, "same line here\n" + text(30) + "\nsame line here", "en", "src3", 1, 1, "a", "i", "r"),
        (-3, "nul\0inside " + text(25), "es", "src5", 1, 1, "a", "i", "r"),
    ]
    rows += [(100 + i, base if i % 3 else text(60), "en", "src0", 1, 1, "a", "i", "r") for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()
