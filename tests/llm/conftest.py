from __future__ import annotations

import pytest

WORDS = [f"w{i}" for i in range(400)]


def passage(start: int, n: int) -> str:
    return " ".join(WORDS[(start * 7 + i * 13) % 400] for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows and ids, copies, a long text, a clashing extra column."""
    base = "\n".join(passage(i, 30) for i in range(4))
    rows = [
        (1, base, "en", 10), (2, base, "en", 11), (2, base, "en", 11), (3, base + " tail", "en", 12), (4, None, "en", 13), (5, "", None, 14),
        (6, " \n ", "en", 15), (None, passage(50, 40), "de", 16), (None, None, None, None), (7, "one two", "de", 17),
        (7, "Mail a.b@c.example or 10.1.2.3", "de", 18), (8, passage(90, 6000), "de", 19)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard long")
