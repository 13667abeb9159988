"""Small fixtures: the cases every operator has to define, and brute-force helpers."""

from __future__ import annotations

import random
import re

import pytest

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    parts = ["the", "of", "and", "ing", "er", "ble", "ou", "é", "sch", "ción", "st", "wh"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = re.findall(r"[^ \t-\r]+", (text or "").translate(_LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


SHARED = prose(99, 60)
LONG = prose(1, 9000)
TEXTS = [
    (1, prose(2, 80)),
    (2, prose(2, 80)),  # a copy
    (3, prose(2, 80) + " Few more words."),  # a near copy
    (4, prose(3, 50) + "\n" + SHARED + "\n" + prose(4, 30)),
    (5, prose(5, 70) + "\n" + SHARED),
    (6, None),
    (7, ""),
    (8, "  \n\t "),
    (9, "One"),
    (10, "ONE"),
    (11, LONG),
    (12, "x" * 700),
    (13, "ab " * 400),
    (14, "Ünïcödé 😀 中文 text, and more of it."),
    (14, "Ünïcödé 😀 中文 text, and more of it."),  # a repeated row
    (None, prose(6, 40)),
]


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with a column whose name an operator might want for itself."""
    rows = [(i, t, "kept") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, score string")
