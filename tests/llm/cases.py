"""Small tables with the awkward cases that every operator must take: NULLs, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest

#: Extra columns are named like those the operators make themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, fp long, tie long, row string, doc long"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    made = ["".join(draw.choice(["an", "er", "tion", "the", "st", "ou", "le"]) for _ in range(draw.randint(1, 4))) for _ in range(words)]
    return " ".join(made)


def documents() -> list[tuple]:
    texts: list[tuple[int | None, str | None]] = [
        (1, prose(1, 200)),
        (2, prose(1, 200)),  # an exact copy
        (3, prose(1, 199) + " changed"),
        (4, prose(4, 120) + " " + prose(99, 70) + " " + prose(5, 40)),
        (5, prose(6, 80) + "\n" + prose(99, 70)),  # a shared passage
        (6, ""),
        (7, None),
        (8, "  \n\t "),
        (9, prose(9, 20_000)),
        (10, "x" * 200_000),
        (11, "the " * 500),
        (12, "éàü Straße naïve 123 !!! — 𝒳 \x00 \x1c"),
        (13, prose(13, 60)),
        (13, prose(13, 60)),  # a repeated row
        (13, prose(14, 60)),  # another text under the same doc_id
        (None, prose(15, 60)),
        (None, prose(1, 200)),
        (None, None),
        (20, "12345 67890"),
    ]
    return [(i, t, None if k % 5 == 0 else "en", "s", None, 7, 8, 9, "row", 3) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3, "source", "n_chars", "text").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
