"""Names of one person agree, and columns of the caller survive whatever they are called."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyward.llm import decontaminate, linededup, pii, setsketch


def replaced(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["text"], r["n_replaced"]) for r in pii.replace_personal_data(docs).collect()}


def test_short_forms_and_untitled_mentions_agree_with_the_full_name(spark):
    got = replaced(
        spark, "Mrs Anna Lee came. Anna Lee said that Lee, not LEE's dog or Leeds, slept.", "Mr John Smith met Dr Smith and Ms. Curie's son.",
        "Dr Juan Carlos Mora Ruiz left.", "Mr Γιώργος Παππάς and Господин Пётр Иванов", "Anna Lee without a title", None, "")
    text, n = got[0]
    anna, lee = re.match(r"Mrs (\w+) (\w+) came\.", text).groups()
    assert text == f"Mrs {anna} {lee} came. {anna} {lee} said that {lee}, not {lee.upper()}'s dog or Leeds, slept." and n == 5  # one with a title and four words without
    assert anna.endswith("na") and not {"Anna", "Lee"} & {anna, lee}
    john, smith, again, curie = re.match(r"Mr (\w+) (\w+) met Dr (\w+) and Ms\. (\w+)'s son\.$", got[1][0]).groups()
    assert smith == again and john.endswith("no") and len({john, smith, curie, "John", "Smith", "Curie"}) == 6 and got[1][1] == 3
    assert re.match(r"Dr \w+ \w+ \w+ \w+ left\.$", got[2][0]) and not set(got[2][0].split()) & {"Juan", "Carlos", "Mora", "Ruiz"}
    assert re.match(r"Mr [Ͱ-Ͽ]+ [Ͱ-Ͽ]+ and Господин [Ѐ-ӿ]+но [Ѐ-ӿ]+$", got[3][0])
    assert not set(got[3][0].split()) & {"Γιώργος", "Παππάς", "Пётр", "Иванов"}
    assert got[4] == ("Anna Lee without a title", 0) and got[5] == (None, 0) and got[6] == ("", 0)


def test_no_name_leaks_and_surrogates_are_distinct(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    before = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    after = {r["doc_id"]: r["text"] or "" for r in pii.replace_personal_data(docs).collect()}
    assert before.keys() == after.keys()
    name = re.compile(rf"(?<!\w)(?:{'|'.join(pii.MALE + pii.FEMALE + pii.NEUTRAL)})\.? ([A-Z][a-z]+(?: [A-Z][a-z]+){{0,3}})")
    for i, text in before.items():
        for words in name.findall(text):
            assert not any(re.search(rf"(?<![\w'-]){w}(?![\w'-])", after[i]) for w in words.split())
    changed = sum(before[i] != after[i] for i in before)
    assert 0 < changed < len(before)


NAMES = ["row_a", "_row_a", "_new_text", "_loc", "_host", "_cuts", "text_", "Kind", "at", "canon", "new", "times", "loc", "n"]


@pytest.mark.parametrize("run", [
    pii.replace_personal_data, setsketch.representatives, linededup.dedup_lines,
    lambda docs: decontaminate.decontaminate(docs, docs.select(F.lit("a").alias("item_id"), "text").limit(0))])
def test_columns_of_the_caller_stay(spark, odd_docs, run):
    docs = odd_docs
    for c in NAMES:
        docs = docs.withColumn(c, F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    rows = run(docs).collect()
    assert rows and all(r[c] == c + ("-" if r["doc_id"] is None else str(r["doc_id"])) for r in rows for c in NAMES)
