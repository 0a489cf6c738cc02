"""Mixing, sketch search and the Merkle manifest against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyward.llm import manifest, maxsketch, mixing

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def read(sf, name="documents"):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def odd_rows(n=40):
    """Nulls in every column, empty and blank texts, repeated rows and ids, one very long text."""
    rows = [(i, f"word{i % 7} b\nc{i}", "en", f"s{i % 3}", i) for i in range(n)]
    rows += [(2, "again\n\n", None, "s2", 4), (2, "again\n\n", None, "s2", 4), (None, "no id\n", "de", None, None), (None, None, None, None, None),
             (50, "", "en", None, 0), (51, " \n\t ", "en", "", 4), (52, "ä ö\n" * 30_000, "de", "ß", 120_000)]
    return rows


def with_clashes(df):
    for c in ("idx", "n", "hash", "leaf", "row", "name", "known", "path", "query", "size", "_at", "begin", "place"):
        df = df.withColumn(c, F.lit("x"))
    return df


# --- manifest --------------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, i):
    for nodes in levels[:-1]:
        begin = i // 3 * 3
        yield "".join(nodes[begin:i]), "".join(nodes[i + 1:begin + 3])
        i //= 3


def manifest_by_hand(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    groups = {g: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for g, v in groups.items()}
    trees = {g: tree([leaf(r, r[1]) for r in v]) for g, v in groups.items()}
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            path = [*way(trees[g], i), *way(top, at)]
            text = row[1].replace("\n", "") if row[1] is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 else row[1]
            found = leaf(row, text)
            for left, right in path:
                found = digest(left + found + right)
            out.append((row[0], leaf(row, row[1]), trees[g][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), found, found == top[-1][0]))
    return out


def test_manifest_of_the_test_data(spark, sf):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in read(sf)]
    got = manifest.op13_merkle_manifest(spark, sf)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(manifest_by_hand(rows), key=repr)
    assert 0 < sum(not r[6] for r in got) < len(got)


def test_manifest_of_odd_rows_and_of_more_than_one_window(spark, monkeypatch):
    # Windows of 9 leaves, so that sources and the tree above them need several.
    monkeypatch.setattr(manifest, "LEVELS", 2)
    monkeypatch.setattr(manifest, "CHUNK", 9)
    rows = odd_rows(200) + [(1000 + i, f"t{i}\n", "en", f"many{i}", i) for i in range(30)]
    got = manifest.manifest(with_clashes(spark.createDataFrame(rows, DOCUMENTS)).repartition(5))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, manifest_by_hand(rows)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28, 730])
def test_manifest_of_one_source(spark, n):
    rows = [(i, f"t{i}\n", None, None, i) for i in range(n)]
    got = manifest.manifest(spark.createDataFrame(rows, DOCUMENTS))
    assert sorted(map(tuple, got.collect())) == sorted(manifest_by_hand(rows))


# --- sketch search ---------------------------------------------------------------------

def terms_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def search_by_hand(items, docs, top):
    counts = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n, length = len(counts), sum(c[2] for c in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, tf, size in counts:
            m = 75 + 25 * size * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms_of(text))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return out


def test_search_of_the_test_data(spark, sf):
    got = maxsketch.op12_sketch_search(spark, sf)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["score"] == "bigint"
    items = [(r["item_id"], r["text"]) for r in read(sf, "benchmark")]
    assert sorted(map(tuple, got.collect())) == sorted(search_by_hand(items, [(r["doc_id"], r["text"]) for r in read(sf)], 20))


def test_search_of_odd_rows(spark, monkeypatch):
    # Small chunks, a sketch of few coordinates and batches of few queries: bounds are loose, thresholds travel.
    monkeypatch.setattr(maxsketch, "CHUNK_DOCUMENTS", 3)
    monkeypatch.setattr(maxsketch, "CHUNK_TERMS", 40)
    monkeypatch.setattr(maxsketch, "WIDTH", 8)
    monkeypatch.setattr(maxsketch, "LEADING", 3)
    monkeypatch.setattr(maxsketch, "BATCH_TERMS", 6)
    draw = np.random.default_rng(5)
    rows = odd_rows() + [(100 + i, " ".join(f"w{x}" for x in draw.zipf(1.3, 30) % 50), "en", "z", 1) for i in range(60)]
    docs = with_clashes(spark.createDataFrame(rows, DOCUMENTS)).repartition(4)
    items = [(1, "w1 W2 w2, w3"), (1, "w5-w7"), (2, None), (3, ""), (4, "nowhere"), (None, "word1 again ä again"), (5, "Ä no ID b")]
    got = maxsketch.ranked_search(with_clashes(spark.createDataFrame(items, "item_id long, text string")), docs, 7)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, search_by_hand(items, [r[:2] for r in rows], 7)))


def test_sketches_bound_all_scores_and_prune():
    draw = np.random.default_rng(2)
    found = [draw.integers(0, 3_000, 80).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(400)]
    terms, times, starts = maxsketch.counted(found)
    chunk = maxsketch.Chunk(np.full(400, 80), starts, terms, times, 400, 400 * 80)
    asked, weights = np.unique(found[7][:20]), np.arange(1, 1 + len(np.unique(found[7][:20])))
    exact = chunk.scores(np.arange(400), asked, weights)
    assert (chunk.bounds(asked, weights) >= exact).all() and exact.argmax() == 7
    floor = int(np.sort(exact)[-5])
    assert 5 <= (chunk.bounds(asked, weights) >= floor).sum() < 200
    assert sorted(chunk.best(asked, weights, 0, 5), reverse=True)[:5] == sorted(((int(s), d) for d, s in enumerate(exact)), reverse=True)[:5]


# --- mixing ----------------------------------------------------------------------------

def targets_by_hand(sizes):
    """Excess shared anew by weight, again and again. ``sizes`` in the order of the sources."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    target, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_ and left > 1e-9:
        whole = sum(weights[i] for i in open_)
        for i in open_:
            target[i] += left * weights[i] / whole
        left = sum(max(0.0, t - 3 * s) for t, s in zip(target, sizes))
        target = [min(t, 3.0 * s) for t, s in zip(target, sizes)]
        open_ = {i for i in open_ if target[i] < 3 * sizes[i]}
    return target


def check_mix(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, targets_by_hand([sizes[s] for s in order])))
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows if r[0] is not None}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]] if r["doc_id"] is not None else None
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s], rel=1e-9) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    assert Counter((r[0], len((r[1] or "").encode().split())) for r in rows) == Counter((r["doc_id"], r["size"]) for r in got)


def test_mix_of_the_test_data_and_again(spark, sf):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in read(sf)]
    frame = mixing.op11_source_mixing(spark, sf)
    assert frame.columns == ["doc_id", "size", "source_size", "target", "taken"] and dict(frame.dtypes)["taken"] == "bigint"
    got = frame.collect()
    check_mix(rows, got)
    # Another run over other partitions takes the same words.
    again = mixing.mix(spark.createDataFrame(rows, DOCUMENTS).repartition(3))
    assert sorted(map(tuple, got)) == sorted(map(tuple, again.collect()))


def test_mix_of_odd_rows(spark):
    # A small source with a high weight meets the limit of three times its size.
    rows = odd_rows() + [(200 + i, "x " * 400, "en", "t", 1) for i in range(20)] + [(300, "only few words", "en", "!", 1)]
    check_mix(rows, mixing.mix(with_clashes(spark.createDataFrame(rows, DOCUMENTS).repartition(4)), shards=5, block=16).collect())


def test_spans_are_disjoint_and_shards_even(spark, path):
    rows = [(i, "w " * (1 + i * 7 % 90), "en", f"s{i % 4}", i) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    placed, planned = mixing.placed(docs, 16)
    spans = mixing.spans_of(placed, planned, 6, 16).collect()
    read_words = defaultdict(Counter)
    for s in spans:
        read_words[s["doc_id"], s["pass"]].update(range(s["first"], s["first"] + s["words"]))
    assert all(set(c.values()) == {1} for c in read_words.values())
    size = {i: 1 + i * 7 % 90 for i, *_ in rows}
    # Passes before a source's last are whole.
    last = {r["idx"]: (r["draws"] - 1) // r["blocks"] for r in planned.collect()}
    at = {r["doc_id"]: r["idx"] for r in placed.collect()}
    for doc, n in size.items():
        for p in range(last[at[doc]]):
            assert len(read_words[doc, p]) == n
    blocks = Counter(s for s, _ in {(s["shard"], (s["idx"], s["place"])) for s in spans})
    assert max(blocks.values()) - min(blocks.values()) <= 1 and len(blocks) == 6
    mixing.write_mix(docs, f"{path}/mix", 6, 16)
    written = spark.read.parquet(f"{path}/mix")
    assert written.agg(F.sum("words")).first()[0] == sum(s["words"] for s in spans) and written.select("shard").distinct().count() == 6


def test_quotas_keep_both_sums_and_follow_the_hypergeometric_law(spark):
    counts, shards = [700, 250, 0, 49, 1], 8
    slots = [125] * 8
    frame = spark.range(400).selectExpr("id AS key", f"array({','.join(f'{c}L' for c in counts)}) AS counts", f"array({','.join(f'{s}L' for s in slots)}) AS slots")
    tables = defaultdict(dict)
    for r in mixing.split_quotas(frame, shards).collect():
        tables[r["key"]][r["shard"]] = r["counts"]
    cells = np.array([[tables[k][j] for j in range(shards)] for k in sorted(tables)])
    assert cells.shape == (400, 8, 5) and (cells >= 0).all()
    assert (cells.sum(axis=1) == counts).all() and (cells.sum(axis=2) == slots).all()
    for i, c in enumerate(counts):
        variance = 125 * (c / 1000) * (1 - c / 1000) * (875 / 999)
        assert abs(cells[:, :, i].mean() - c / 8) < 1e-9
        assert cells[:, 3, i].mean() == pytest.approx(c / 8, abs=4 * math.sqrt(variance / 400) + 1e-9)
        assert cells[:, 3, i].var() == pytest.approx(variance, rel=0.35, abs=0.05)


def test_a_draw_is_the_inverse_of_its_distribution(spark):
    rows = [(total, good, drawn, (i + 0.5) / 40) for total, good, drawn in ((20, 7, 5), (20, 20, 5), (20, 0, 5), (1, 1, 1), (30, 25, 20)) for i in range(40)]
    got = spark.createDataFrame(rows, "total long, good long, drawn long, u double").withColumn(
        "x", mixing.hypergeometric(F.col("total"), F.col("good"), F.col("drawn"), F.col("u"))).collect()
    for r in got:
        total, good, drawn = r["total"], r["good"], r["drawn"]
        share = [math.comb(good, k) * math.comb(total - good, drawn - k) / math.comb(total, drawn) for k in range(drawn + 1)]
        assert sum(share[:r["x"]]) - 1e-9 <= r["u"] <= sum(share[:r["x"] + 1]) + 1e-9


def test_permutations(spark):
    for size in (1, 2, 37, 1000):
        got = [r[0] for r in spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size).cast("long"), F.lit(3))).collect()]
        assert sorted(got) == list(range(size))
        assert size < 37 or sum(a == i for i, a in enumerate(got)) < 10


@pytest.mark.parametrize("run", [mixing.mix, manifest.manifest, lambda d: maxsketch.ranked_search(d.withColumnRenamed("doc_id", "item_id"), d)])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCUMENTS)).count() == 0
