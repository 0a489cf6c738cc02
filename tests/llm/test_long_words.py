"""Words, queries and scores where some words are longer than a hash's table of places."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from test_new_operators import search_by_hand

from tallyward.llm import attention, common, maxsketch, search
from tallyward.llm.common import tokenizer_path, word_hashes, words_of

# More texts than go into one run of word_hashes; every fifth has a long word, and runs with and without one take turns.
LONG = ["y" * 65, "Z" * 64 + "ab", "z" * 128 + "é", "x" * 300]


@pytest.fixture
def rows(monkeypatch):
    monkeypatch.setattr(common, "_CHUNK_CHARS", 200)
    draw = np.random.default_rng(3)
    found = []
    for i in range(120):
        words = [f"W{x}" for x in draw.zipf(1.4, 25) % 60]
        found.append((i, "\t".join(words + ([LONG[i // 5 % 4]] if i % 5 == 0 else []))))
    return found + [(200, None), (201, ""), (202, " \n"), (3, found[3][1]), (203, "a\x00b \x1c \x85   c"), (204, LONG[0])]


def test_a_word_has_one_hash_beside_longer_ones(rows):
    texts = [t for _, t in rows]
    by = {}
    for text, hashes in zip(texts, word_hashes(texts)):
        for w, h in zip(words_of(text), hashes.tolist(), strict=True):
            assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    for w, h in by.items():
        assert next(word_hashes([w.decode()])).tolist() == [h]


def test_language_model_counts_words_beside_longer_ones(spark, rows):
    counts, n = Counter(), 0
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, text in rows:
        if not held[i]:
            counts.update(words_of(text) + [None])
            n += len(words_of(text)) + 1
    want = []
    for i, text in rows:
        words = words_of(text) + [None]
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words)
        want.append((i, held[i], len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    got = attention.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), tokenizer_path()).collect()
    assert sorted((*r[:5], round(r["base_score"], 6)) for r in got) == sorted(want)


def test_ranked_search_beside_longer_words(spark, rows):
    items = [(1, "w1 w2, w3"), (2, f"w5 {LONG[1]}"), (3, LONG[0]), (4, "w7 w7 w8")]
    got = maxsketch.ranked_search(spark.createDataFrame(items, "item_id long, text string"),
                                  spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(search_by_hand(items, rows, 20))


def test_search_beside_longer_words(spark, rows):
    docs = [(i, words_of(t)) for i, t in rows]
    mean = sum(len(w) for _, w in docs) / len(docs)
    counted = [(i, Counter(w), len(w)) for i, w in docs]
    df = Counter(x for _, c, _ in counted for x in c)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = [(i, c) for i, c, _ in counted if i % 20 == 0]
    got = search.search(frame.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id"), frame, len(rows)).collect()
    want = []
    for i, c in asked:
        scores = [sum(math.log(1 + (len(docs) - df[x] + 0.5) / (df[x] + 0.5)) * d[x] * 2.2 / (d[x] + 1.2 * (0.25 + 0.75 * n / mean))
                      for x in c.keys() & d.keys()) for _, d, n in counted]
        want += [(i, j, round(s, 6)) for (j, _, _), s in zip(counted, scores) if s > 0]
    assert sorted((r["query_id"], r["doc_id"], round(r["score"], 6)) for r in got) == sorted(want)
