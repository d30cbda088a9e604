"""Small awkward tables that every training-data operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))


def prose(seed: int, words: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "a", "river", "stone", "cloud", "paper", "garden", "silver", "morning", "window", "letter", "train"]) + ("." if rng.random() < 0.1 else "") for _ in range(words))


def awkward_rows() -> list[tuple]:
    base = prose(1)
    rows = [
        (1, base, "en", "s1", 1),
        (2, base, "en", "s1", 1),  # an exact copy
        (3, base + " and one more ending", "en", "s2", 1),  # a near copy
        (4, None, "en", "s1", None),
        (5, "", None, None, 0),
        (6, " \t\n\x0b\x0c\r ", "de", "s2", 0),
        (7, "one", "en", "s2", 1),
        (8, "one two", "en", None, 1),
        (9, LONG, "en", "s1", 1),
        (10, "Ünïcode ΣΊΣΥΦΟΣ İstanbul 日本語 😀 <|endoftext|> <|im_end|>", "de", "s3", 1),
        (11, prose(2), None, "s3", 1),
        (11, prose(2), None, "s3", 1),  # a repeated row
        (None, prose(3), "en", "s1", 1),
        (None, None, None, None, None),
        (12, "12345 !!! ???", "fr", "s3", 1),
    ]
    return rows + [(100 + i, prose(50 + i, 20 + i), ["en", "de"][i % 2], f"s{i % 3}", 1) for i in range(20)]


def awkward(spark):
    """The rows with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(awkward_rows(), DOCS)
    return df.selectExpr("*", "'x' AS kept", "1 AS id", "'y' AS key", "2 AS n", "3 AS shard", "'z' AS ids", "0.5D AS score", "4 AS _id", "5 AS size", "6 AS root")


def none(spark):
    return spark.createDataFrame([], DOCS)
