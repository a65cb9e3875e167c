from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside or return, as columns of the input.
CLASHES = ("key", "row", "name", "h", "kept", "size", "score", "set", "class", "members", "taken", "length", "line", "run",
           "__key", "__h", "__dropped", "__twins", "__links", "__lines", "__had", "__id", "__uses", "__use", "__size", "__members",
           "dropped", "twins", "links", "had", "id", "least", "more", "use", "t", "by0", "weight", "rank", "groups")


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(("th", "er", "on", "an", "re", "he", "in")) for _ in range(r.randint(1, 4))) for _ in range(words))


def rows() -> list[tuple]:
    long = prose(1, 40_000)
    base = prose(2, 120)
    near = base.replace(base.split()[60], "changed", 1)
    texts = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, None, "en", None), (4, "", None, "b"),
        (None, prose(3, 30), "fr", "b"), (5, long, "fr", "a"), (5, long, "fr", "a"), (6, "Äpfel ÉTÉ ınfo 中文 😀", "de", "c"),
        (7, near, "en", "c"), (8, " \t\n", "en", "a"), (9, "one two", "en", None), (10, "One TWO", None, "a"),
        (11, "x" * 9000 + "A", "en", "b"), (12, "x" * 9000 + "a", "en", "b"), (13, "\n\n" + base + "\n" + base + "\nend", "en", "a"),
    ]
    return [(k, t, g, s, len(t or "")) for k, t, g, s in texts]


@pytest.fixture()
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    df = spark.createDataFrame(rows(), COLUMNS)
    return df.selectExpr("*", *[f"'clash' AS `{c}`" for c in CLASHES])


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], COLUMNS)
