"""Shared inputs of the operator tests."""

from __future__ import annotations

import random
import re

SPACE = "\x20\x09-\x0d"
WORD = re.compile(f"[^{SPACE}]+")

LONG = " ".join(f"w{i % 700}x{i}" for i in range(30_000))

# NULLs in any column, empty and blank texts, a very long text, repeated rows and ids, ties.
ODD = [
    (1, "", "en", "a"),
    (2, None, "en", "a"),
    (3, " \n\t ", None, None),
    (4, LONG, "en", "b"),
    (5, "same words in a row for all of us here\nand a second line of them", "en", "a"),
    (5, "same words in a row for all of us here\nand a second line of them", "en", "a"),
    (6, "same words in a row for all of us here\nand a second line of them", None, "c"),
    (None, "same words in a row for all of us here\nand a second line of them", "en", None),
    (None, None, None, None),
    (7, "one", "xx", ""),
    (8, "A\0b été \U0001f600 ퟿", "fr", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# Extra columns named like the operators' own.
EXTRA = ("size", "target", "taken", "_row", "_text", "version", "key", "node", "kept", "_score", "mention", "n_words")


def odd_docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    return df.select("*", *(F.concat(F.lit(c), F.coalesce("doc_id", F.lit(-1)).cast("string")).alias(c) for c in EXTRA))


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"t{rng.randrange(vocabulary)}" for _ in range(n))


def same_rows(a, b) -> None:
    """Two DataFrames hold the same rows (any order, NULLs equal)."""
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
