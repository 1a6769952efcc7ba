from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    base = " ".join(f"w{i % 97}x{i % 31}" for i in range(300))
    rows = [(1, base, "a", "en", 1), (2, base, "a", "en", 2), (3, base.replace("w5x5", "other"), None, "en", 3), (4, None, "b", None, 4),
            (5, "", "b", "en", 5), (6, " \n\t ", "c", "en", 6), (7, "one two three", "c", "en", 7), (7, "one two three", "c", "en", 7),
            (8, "ONE two THREE", "c", "en", None), (None, base + " more", "a", "en", 9), (10, "word " * 60_000, "d", "en", 10),
            (11, "\n".join(f"line {i} of the text and so on {i * 7}" for i in range(400)), "d", "en", 11), (12, "<|endoftext|> x", "é", "en", 12)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size long").selectExpr(
        "*", "1 as n", "'x' as shard", "2 as slot", "3 as key", "4 as _hash", "5 as bytes", "6 as target")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
