"""What top-k search reads and keeps, with small shards and blocks, against plain sums over all pairs."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyward.llm import search
from tallyward.llm.common import words_of


@pytest.fixture
def rows():
    draw = np.random.default_rng(8)
    found = [(i, " ".join(f"w{x}" for x in draw.zipf(1.3, int(draw.integers(1, 60))) % 400)) for i in range(500)]
    # Copies in all shards, repeated and null ids, texts without words.
    found += [(i, found[i % 7][1]) for i in range(500, 620)]
    return found + [(3, found[3][1]), (None, found[5][1]), (None, "w1 w2"), (700, None), (720, " \n"), (740, "w1 " * 300)]


@pytest.mark.parametrize("first", [1, 3, 10**9])
def test_search_keeps_little_beside_the_best(spark, monkeypatch, rows, first):
    for name, value in (("SHARD_DOCUMENTS", 40), ("BLOCK", 8), ("QUERIES_AT_ONCE", 12), ("BLOCKS_AT_ONCE", 2), ("AT_ONCE", 5),
                        ("FREQUENT", 4), ("MOST_FREQUENT", 30), ("FEW", 4), ("SHARDS_PER_FIRST", first)):
        monkeypatch.setattr(search, name, value, raising=False)
    written, durable = defaultdict(int), search.durable

    def counted(df, name="step"):
        found = durable(df, name)
        written[name] += found.count()
        return found

    monkeypatch.setattr(search, "durable", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = defaultdict(list)
    for r in search.search(docs.where("doc_id % 10 = 0").withColumnRenamed("doc_id", "query_id"), docs).collect():
        got[r["query_id"]].append((r["rank"], r["doc_id"], round(r["score"], 7)))
    counted_words = [(i, Counter(words_of(t)), len(words_of(t))) for i, t in rows]
    mean = sum(n for *_, n in counted_words) / len(rows)
    df = Counter(x for _, c, _ in counted_words for x in c)
    asked = [(i, c) for i, c, _ in counted_words if i is not None and i % 10 == 0]
    for i, c in asked:
        scores = sorted((-round(sum(math.log(1 + (len(rows) - df[x] + 0.5) / (df[x] + 0.5)) * d[x] * 2.2 / (d[x] + 1.2 * (0.25 + 0.75 * n / mean))
                                    for x in sorted(c.keys() & d.keys())), 7), j is not None, j or 0, j) for j, d, n in counted_words)
        want = [(k, s[3], -s[0]) for k, s in enumerate([s for s in scores if s[0] < 0][:10], 1)]
        assert [r[:2] for r in sorted(got[i])] == [r[:2] for r in want]
        assert np.allclose([r[2] for r in sorted(got[i])], [r[2] for r in want], atol=2e-7)
    # Queries of the same words are asked once, and a task keeps the best of all its shards.
    kinds = len({frozenset(c) for _, c in asked if c})
    assert written["weighted"] == kinds < len(asked)
    assert written["found"] <= 2 * 10 * kinds * (1 if first in (1, 10**9) else 2)
