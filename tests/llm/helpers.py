"""Small tables with the cases that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, uid string, n string"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(n))


def lines(seed: int, n: int) -> str:
    return "\n".join(words(seed * 1000 + k, 12) for k in range(n))


def corpus() -> list[tuple]:
    """Near and exact copies, shared passages, empty and null texts, one very long text, nulls in every column."""
    shared, long = lines(7, 6), lines(99, 900)
    texts = [lines(1, 8), lines(1, 8), words(2, 120), words(2, 119) + " zz", lines(3, 3) + "\n" + shared, shared + "\n" + lines(4, 3), "", None, "one", "one two", " \n ", "é ü ß " * 40, "aaaa" * 100, long, long + "\nend", "x y z " * 60]
    rows = [(k, t, ["en", "de", None][k % 3], ["s0", "s1", None, "s2"][k % 4], None if t is None else len(t), "clash", None, "3") for k, t in enumerate(texts)]
    return rows + [(None, words(5, 60), "en", "s0", 1, None, "u", None), (50, words(6, 80), None, None, None, "b", "u", "1")]


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA)
