"""Each operator against a brute-force version, on the test data and on awkward rows."""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyward.llm import attention, decontaminate, html, language, linededup, packing, pii, search, setsketch, sharding
from tallyward.llm.common import WordIds, tokenizer_path, word_hashes, words_of
from tallyward.llm.graph import components, merged


def read(sf, name="documents"):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def test_word_hashes_agree_with_words():
    texts = ["A b\ta  c", None, "", "x" * 200 + " é É", "a b \x1c c"]
    words, hashes = [words_of(t) for t in texts], list(word_hashes(texts))
    assert [len(h) for h in hashes] == [len(w) for w in words]
    by = defaultdict(set)
    for w, h in zip(sum(words, []), np.concatenate(hashes)):
        by[w].add(int(h))
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)


def test_ids_found_word_by_word(sf):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    texts = [r["text"] for r in read(sf)[:60]] + ["A b,, 'S it's İΣ<|endoftext|>, <|STARTOFTEXT|>. a.b c,' !", "", None, " e ́ é,"]
    own = WordIds(open(tokenizer_path(), encoding="utf-8").read())
    for text, ids in zip(texts, own.encode(texts)):
        assert whole.encode(text or "", add_special_tokens=False).ids == ids.tolist()


def test_html_of_a_page():
    page = """<body class=sidebar><header>Site</header><div id=w><div class="sidebar"><p>Side text</div><div class="post-12"><h2>T &eacute;</h2>
    <p>a  <b>b</b><br>c<ul><li>one<li>two</ul><form>x</form><div class=comments><p>said</div></div></div><script>"</p>"</script><footer>f"""
    assert html.extract(page, None) == "T é\n\na b c\n\none\n\ntwo"
    assert html.vote(page)[0].endswith("/div.post-#") and html.extract(None, "/body") == "" and html.vote("") is None


def test_html_pages(spark, sf):
    got = {r["page_id"]: r["text"] for r in html.op1_html_extraction(spark, sf).collect()}
    import html as references

    for r in read(sf, "pages"):
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(references.unescape(re.sub(r"</?(?:b|br)\b[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_html_keeps_headline_lead_and_short_sections(spark):
    long = "word " * 200

    def page(body):
        return f"<body><div class=top>Site</div><nav>menu</nav>{body}<div class=comments>said</div></body>"

    rows = [(1, "http://a.example/1", page(f"<article><h1>T</h1><div class=lead>Lead</div><div class=body><p>{long}</div><div class=share>s</div></article>")),
            (2, "http://a.example/2", page(f"<article><h1>U</h1><div class=lead>Led</div><div class=body><p>{long}</div></article>")),
            (3, "http://b.example/1", page(f"<main><section><p>{long}</section><section>Short</section><aside>x</aside><div class=note>Note</div></main>")),
            (4, "http://c.example/1", page(f"<div><div class=part>{long}</div><p>Between</p><div class=part>Few</div></div>")),
            (5, "http://c.example/2", page(f"<div><div class=part>{long}</div></div>"))]
    got = {r["page_id"]: r["text"] for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    whole = long.strip()
    assert got == {1: f"T\n\nLead\n\n{whole}", 2: f"U\n\nLed\n\n{whole}", 3: f"{whole}\n\nShort\n\nNote", 4: f"{whole}\n\nBetween\n\nFew", 5: whole}


def test_best_fit_by_brute_force():
    lengths = np.random.default_rng(1).integers(1, 65, 300)
    sequence, offset = packing.best_fit_decreasing(lengths, 64)
    room, expected = [], []
    for n in sorted(lengths.tolist(), reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(64 - n)
    expected = sorted(room)
    used = np.bincount(sequence, weights=lengths)
    assert sorted((64 - used).tolist()) == expected
    for s in range(len(used)):
        own = sorted(zip(offset[sequence == s], lengths[sequence == s]))
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own[:-1]]))


def test_packing(spark, odd_docs):
    rows = packing.pack_documents(odd_docs, tokenizer_path()).collect()
    own = WordIds(open(tokenizer_path(), encoding="utf-8").read())
    texts = [r["text"] for r in odd_docs.collect()]
    assert sum(r["length"] for r in rows) == sum(len(i) + 1 for i in own.encode(texts))
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 4096
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0] + [n for _, n in places[:-1]])) and sum(n for _, n in places) <= 4096


def jump(key: int, n: int) -> int:
    b, j, key = -1, 0, key & (1 << 64) - 1
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(spark, odd_docs):
    keys = [0, 1, -1, 2**63 - 1, -2**63, None, *range(1000, 1300)] + [77] * 200
    out = sharding.shard(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 8).collect()
    assert len(out) == len(keys)
    for r in out:
        assert r["shard"] == jump(r["k"] or 0, 8) and r["grown_shard"] == jump(r["k"] or 0, 9) and r["grown_shard"] in (r["shard"], 8)
    for s in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    again = sharding.shard(odd_docs, "doc_id", 3)  # has a column named shard
    assert again.columns.count("shard") == 1 and again.count() == odd_docs.count()


def test_language(spark, sf, odd_docs):
    rows = language.op4_language_id(spark, sf).collect()
    lang = {r["doc_id"]: r["lang"] for r in read(sf)}
    out = [r for r in rows if r["held_out"]]
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in out) >= 0.97 * len(out)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    odd = language.language_id(odd_docs).collect()
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in odd) and len(odd) == odd_docs.count()


def test_languages_are_learned_from_different_texts(spark, sf):
    by_lang = defaultdict(set)
    for r in read(sf):
        if r["text"] and r["lang"]:
            by_lang[r["lang"]].add(r["text"][:500])
    rows = [(t, lang) for lang, texts in by_lang.items() for t in sorted(texts)[:8]]
    once, often = (language.fit(spark.createDataFrame(rows * n, "text string, lang string"), fit_rows=4) for n in (1, 5))
    assert np.allclose(once.scale, often.scale) and np.allclose(once.weights, often.weights)


def test_first_texts_of_a_language_are_found_in_two_steps(spark):
    rows = spark.range(0, 20_000, 1, 40).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("lang"), F.xxhash64("id").alias("_a"), F.col("id").alias("_b"))
    chosen = language.first_of_each(rows, 25)
    by_lang = defaultdict(list)
    for r in rows.collect():
        by_lang[r["lang"]].append((r["_a"], r["_b"]))
    assert sorted(map(tuple, chosen.collect())) == sorted((lang, *x) for lang, xs in by_lang.items() for x in sorted(xs)[:25])
    text = chosen._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # Each step drops what is behind already before its shuffle.
    assert text.count("WindowGroupLimit") == 4 and text.count("Exchange hashpartitioning") == 2


def test_search(spark, sf):
    docs = [(r["doc_id"], words_of(r["text"])) for r in read(sf)]
    mean = sum(len(w) for _, w in docs) / len(docs)
    counted = [(i, Counter(w), len(w)) for i, w in docs]
    df = Counter(x for _, c, _ in counted for x in c)
    got = defaultdict(list)
    for r in search.op5_topk_search(spark, sf).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["doc_id"], r["score"]))
    for i, c, _ in counted:
        if i % 20 == 0:
            scores = [(-round(sum(math.log(1 + (len(docs) - df[x] + 0.5) / (df[x] + 0.5)) * d[x] * 2.2 / (d[x] + 1.2 * (0.25 + 0.75 * n / mean))
                                  for x in c.keys() & d.keys()), 7), j) for j, d, n in counted]
            best = [(j, -s) for s, j in sorted(s for s in scores if s[0] < 0)[:10]]
            assert [j for j, _ in best] == [j for j, _ in got[i]] and np.allclose([s for _, s in best], [s for _, s in got[i]])


def test_surrogates(spark, odd_docs):
    rows = [(1, "bob.S@mail1.example.com BOB.s@mail1.example.com +1 (386) 555-3733 IP 10.2.3.44 4111 1111 1111 1111"),
            (2, "Mrs. Anna Lee met Ms ANNA LEE and Mr Lee. password=abc123def4567 2.0. 3.4.5"), (3, "bob.s@mail1.example.com")]
    out = {r["doc_id"]: r["text"] for r in pii.replace_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    mail = out[3]
    assert out[1].lower().split()[:2] == [mail, mail] and mail != rows[2][1] and mail.endswith(".com")
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4} IP \d+\.\d+\.\d+\.\d+ 4\d{3} \d{4} \d{4} \d{4}$", out[1])
    assert not any(x in out[1] for x in ("555-3733", "10.2.3.44", "1111 1111"))
    first = re.match(r"Mrs\. (\w+ \w+) met Ms (\w+ \w+) and Mr \w+\. password=\w{13} 2\.0\. 3\.4\.5$", out[2])
    assert first[1].upper() == first[2] and "Anna" not in out[2] and first[1].split()[0].endswith("na")
    assert pii.replace_personal_data(odd_docs).count() == odd_docs.count()


def test_surrogates_that_meet_are_drawn_again(spark):
    entities = spark.createDataFrame([("ssn", str(n)) for n in range(10)], "kind string, canon string").withColumn("gender", F.lit(None).cast("string"))
    some = entities.where("canon < '5'")  # ten forms, five of them taken by entities
    assert pii.surrogates(some, "k").select("surrogate").distinct().count() == 5


def smallest_reachable(links):
    root = {n: n for link in links for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("late", [0, 1, 25])
def test_components_and_links_found_later(spark, late):
    draw = np.random.default_rng(late)
    links = [tuple(sorted(map(int, draw.choice(120, 2, replace=False)))) for _ in range(70)] + [(i, i + 1) for i in range(200, 230)]
    first, then = links[late:], [*links[:late], *[(500 + i, 3 + i) for i in range(late)]]
    frame = [spark.createDataFrame(x, "a long, b long") for x in (first, then)]
    roots = components(frame[0])
    assert dict(roots.collect()) == smallest_reachable(first)
    assert dict(merged(roots, frame[1]).collect()) == smallest_reachable(first + then)


def brute_components(docs, percent=85):
    sets = {}
    for name, text in docs:
        w = words_of(text)
        sets[name] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {n: n for n in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return sets, {n: find(n) for n in names}


def test_near_duplicates(spark, sf, odd_docs):
    sets, root = brute_components([(r["doc_id"], r["text"]) for r in read(sf)])
    for r in setsketch.op7_near_dedup(spark, sf).collect():
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
    odd = setsketch.near_duplicates(odd_docs).collect()
    assert len(odd) == odd_docs.count() and {r["component_id"] for r in odd if r["doc_id"] in (1, 2, 3)} == {1}
    stay = setsketch.representatives(odd_docs).collect()
    assert sum(r["doc_id"] in (1, 2, 3) for r in stay) == 1 and sum(r["text"] is None for r in stay) == 2


def test_sketches_merge():
    a, b = (np.random.default_rng(s).integers(0, 2**64, 500, dtype=np.uint64) for s in (1, 2))
    assert (setsketch.registers(np.union1d(a, b)) == np.maximum(setsketch.registers(a), setsketch.registers(b))).all()


def test_leaks(spark, sf, odd_docs):
    def plain(text):
        return " ".join((text or "").lower().split())

    items = [(r["item_id"], plain(r["text"])) for r in read(sf, "benchmark")]
    held = {(r["doc_id"], i) for r in read(sf) for i, t in items if t in plain(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.op8_decontamination(spark, sf).collect()}
    assert len(held & got) >= 0.9 * len(held)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(odd_docs, none).count() == odd_docs.count()


def test_no_copy_and_no_rewording_in_place_is_lost(spark, sf):
    draw = np.random.default_rng(4)
    items, docs = [r for r in read(sf, "benchmark")], [words_of(r["text"]) for r in read(sf)]
    docs = [[w.decode() for w in d] for d in docs if len(d) > 300][:20]
    short = [(10_000 + i, " ".join(docs[i % 20][20 * i % 200:][:5 + i % 20])) for i in range(40)]
    rows, held = [], set()
    for n, (name, text) in enumerate([*((r["item_id"], r["text"]) for r in items), *short]):
        item = text.split()
        for kind, share in enumerate((1.0, 0.8)):
            gone = set(draw.permutation(len(item))[:int(len(item) * (1 - share) + 1e-9)].tolist())
            copy = [f"other{draw.integers(1000)}" if i in gone and draw.integers(2) else w for i, w in enumerate(item) if i not in gone or draw.integers(2)]
            host = docs[(n + kind + 7) % len(docs)]
            rows.append((len(rows), " ".join(host[:150] + copy + host[150:300])))
            if sum(i not in gone for i in range(len(item))) >= 0.8 * len(item):
                held.add((len(rows) - 1, name))
    # No cosine at all: copies do not depend on it.
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame([*((r["item_id"], r["text"]) for r in items), *short], "item_id long, text string"), cosine=2.0)
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert held and held <= got.keys() and all(got[h]["copy"] and -1.001 <= got[h]["cosine"] <= 1.001 for h in held)
    plain = [(r["item_id"], " ".join(r["text"].lower().split())) for r in items]
    whole = {(r["doc_id"], i) for r in read(sf) for i, t in plain if t in " ".join((r["text"] or "").lower().split())}
    assert whole and whole <= {(r["doc_id"], r["item_id"]) for r in decontaminate.op8_decontamination(spark, sf).collect()}


def test_rewordings_leave_as_many_runs_as_are_asked_for():
    for n in range(1, 60):
        size, need = decontaminate.reworded_grams(n)
        gone = int((1 - decontaminate.REWORDED) * n + 1e-9)
        for draw in range(40):
            lost = np.random.default_rng(draw).permutation(n)[:gone]
            kept = np.ones(n, bool)
            kept[lost] = False
            assert sum(kept[i:i + size].all() for i in range(n - size + 1)) >= need >= 1
            size_of_copy = decontaminate.copy_gram(n)
            kept = np.ones(n, bool)
            kept[lost[:int((1 - decontaminate.COPY) * n + 1e-9)]] = False
            assert any(kept[i:i + size_of_copy].all() for i in range(n - size_of_copy + 1))


def test_lines(spark, sf, odd_docs):
    docs = sorted(read(sf), key=lambda r: r["doc_id"])
    lines = [[x for x in (r["text"] or "").split("\n") if x.encode().split()] for r in docs]
    where = defaultdict(list)
    for d, s in enumerate(lines):
        for i, x in enumerate(s):
            where[x].append((d, i))
    got = {r["doc_id"]: r for r in linededup.op9_line_dedup(spark, sf).collect()}
    for d, s in enumerate(lines):
        gone = set()
        for i in range(len(s)):
            for e, j in where[s[i]]:
                if (e, j) < (d, i):
                    n = next((n for n in range(len(s)) if i + n >= len(s) or j + n >= len(lines[e]) or s[i + n] != lines[e][j + n]), len(s))
                    if sum(len(x.encode().split()) for x in s[i:i + n]) >= 50:
                        gone |= set(range(i, i + n))
        assert got[docs[d]["doc_id"]]["removed_lines"] == len(gone)
        if not gone:
            assert got[docs[d]["doc_id"]]["text"] == docs[d]["text"]
    odd = linededup.dedup_lines(odd_docs)
    assert odd.count() == odd_docs.count() and {r["text"] for r in odd.where("doc_id = 2").collect()} == {""}


def test_language_model(spark, sf, odd_docs):
    rows = read(sf)
    counts, n = Counter(), 0
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            words = words_of(r["text"]) + [None]
            counts.update(words)
            n += len(words)
    got = {r["doc_id"]: r for r in attention.op10_lm_scoring(spark, sf).collect()}
    for r in rows:
        words, g = words_of(r["text"]) + [None], got[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words)
        assert g["n_tokens"] == len(words) and g["n_known"] == sum(counts[w] > 0 for w in words) and g["train_tokens"] == n
        assert g["base_score"] == pytest.approx(base, rel=1e-9) and g["score"] < 0
    assert attention.score_texts(odd_docs, tokenizer_path()).count() == odd_docs.count()


def test_language_model_learns_from_the_end_of_long_texts_and_from_rare_pairs(spark):
    # More than 30,000 ids, of 3,000 kinds; behind them a pair of rare ones.
    vocabulary = json.load(open(tokenizer_path(), encoding="utf-8"))["model"]["vocab"]
    *words, one, other = sorted(w[:-4] for w in vocabulary if re.fullmatch("[a-z]{5,}</w>", w))[:3002]
    filler = words * 11
    names = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(names[0], " ".join(filler + [one, other] + words[:9])), (names[1], " ".join(filler)),
            (held[0], f"{one} {other}"), (held[1], f"{other} {one}")]
    got = {r["doc_id"]: r["score"] for r in attention.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()}
    assert got[held[0]] > got[held[1]] + 0.1


def test_every_training_row_is_read_as_often():
    for passes in (1, 3):
        total, done, times = attention.PARTS * passes, 0.0, Counter()
        for share, _ in attention.ROUNDS:
            times.update({p: attention.readings(p, round(done * total), round((done + share) * total)) for p in range(attention.PARTS)})
            done += share
        assert set(times.values()) == {passes}


def test_a_windowed_score_reads_every_id_once():
    for size in (1, 31, 32, 33, 56, 57, 1000):
        owner, first, done = attention.windows(np.array([size]))
        places = [f + i for f, d in zip(first, done) for i in range(d, attention.WINDOW) if f + i < size]
        assert places == list(range(size))


@pytest.mark.parametrize("run", [
    lambda d: packing.pack_documents(d, tokenizer_path()), lambda d: sharding.shard(d, "doc_id", 8), language.language_id, setsketch.near_duplicates,
    linededup.dedup_lines, pii.replace_personal_data, lambda d: attention.score_texts(d, tokenizer_path()),
    lambda d: search.search(d.withColumnRenamed("doc_id", "query_id"), d),
    lambda d: decontaminate.leaks(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    lambda d: html.extract_text(d.select("doc_id", F.col("lang").alias("url"), F.col("text").alias("html")))])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
