"""Like documents are neighbours in an index of top-k search, and few are scored that are not among the best."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa

from tallyward.llm import search


def texts(kind: str, n: int, seed: int) -> list[str]:
    draw = np.random.default_rng(seed)
    return [" ".join(f"{kind}{x}" for x in draw.zipf(1.2, int(draw.integers(5, 200))) % 300) for _ in range(n)]


def test_like_documents_are_neighbours_short_before_long(spark):
    rows = [t for pair in zip(texts("a", 150, 1), texts("b", 150, 2)) for t in pair]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)
    index, = search.build_index(docs).collect()
    assert sorted(index["names"]) == list(range(300)) and index["sizes"] == [len(rows[i].split()) for i in index["names"]]
    kinds = [rows[i][0] for i in index["names"]]
    # Kinds may be cut further, but none of the runs holds both.
    assert sum(x != y for x, y in zip(kinds, kinds[1:])) < search.KINDS
    ends = np.frombuffer(index["ends"], "<i8").tolist()
    assert ends[-1] == 300 and ends == sorted(ends)
    for lo, hi in zip([0, *ends], ends):
        assert len(set(kinds[lo:hi])) == 1 and index["sizes"][lo:hi] == sorted(index["sizes"][lo:hi])


def test_blocks_that_cannot_be_among_the_best_are_not_looked_at(monkeypatch):
    """One kind of documents and one of queries: the others' blocks are below any score found."""
    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, function, _):
            return function

    rows = [t for pair in zip(texts("a", 400, 3), texts("b", 400, 4)) for t in pair]
    frame = Frame()
    frame.schema = defaultdict(lambda: type("Field", (), {"dataType": type("Kind", (), {"simpleString": lambda self: "bigint"})()})())
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(800)), "text": rows})
    index, = search.build_index(frame)(iter([batch]))
    found = [np.unique(h) for h in search.word_hashes(rows[::8])]
    terms, which = np.unique(np.concatenate(found), return_inverse=True)
    weights = np.linspace(0.5, 6, len(terms))
    cells = [index.column("sizes")[0].as_py()] + [index.column(c)[0].as_buffer() for c in ("terms", "starts", "places", "times", "ends")]
    asked, best, looked = search.Asked(np.array([len(f) for f in found]), which.astype(np.int32), weights), search.Best(len(found), 3), []
    shard = search.Shard(*cells, 100.0, terms, weights, asked.share)
    exact = shard.exact
    monkeypatch.setattr(shard, "exact", lambda words, documents: looked.append(len(documents)) or exact(words, documents))
    shard.better(asked, best, np.zeros(len(found)))
    best.settle(index.column("names")[0].as_py())
    assert sum(looked) < 10 * len(found)
    words = [set(f.tolist()) for f in search.word_hashes(rows)]
    weight, sizes = dict(zip(terms.tolist(), weights)), [len(t.split()) for t in rows]
    for q in range(len(found)):
        times = [dict(zip(*(x.tolist() for x in np.unique(h, return_counts=True)))) for h in search.word_hashes(rows)] if q == 0 else times
        scores = [sum(weight[w] * times[d][w] * 2.2 / (times[d][w] + 1.2 * (0.25 + 0.75 * sizes[d] / 100)) for w in words[d] & set(found[q].tolist())) for d in range(800)]
        held = best.query == q
        want = sorted(range(800), key=lambda d: (-round(scores[d], 9), d))[:3]
        assert [best.names[d] for d in best.document[held]] == want and np.allclose(best.score[held], [scores[d] for d in want])


def test_few_rows_are_written_beside_the_best(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCUMENTS", 40)
    written, durable = [], search.durable

    def counted(df, name="step"):
        found = durable(df, name)
        if name == "found":
            written.append(found.count())
        return found

    monkeypatch.setattr(search, "durable", counted)
    docs = spark.createDataFrame(list(enumerate(texts("a", 2400, 5))), "doc_id long, text string").repartition(60)
    got = search.search(docs.where("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id"), docs)
    # 60 tasks of ten each, had they known nothing of each other; with the best of one shard in 16 known, about 160.
    assert got.count() == 480 and sum(written) < 48 * 120
