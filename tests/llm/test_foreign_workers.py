"""Operators on workers that have no copy of this package."""

from __future__ import annotations

import os
import subprocess
import sys

from tallyward.llm.common import WordIds, read_whole, tokenizer_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # of the driver only
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
assert spark.range(1).rdd.map(lambda _: __import__("importlib.util").util.find_spec("tallyward") is None).first()
from tallyward.llm import attention, html, maxsketch, packing
from tallyward.llm.common import tokenizer_path
docs = spark.createDataFrame([(i, f"some words of text {i} and more") for i in range(30)], "doc_id long, text string")
assert attention.score_texts(docs, tokenizer_path()).where("score < 0").count() == 30
assert packing.pack_documents(docs, tokenizer_path()).count() == 30
assert maxsketch.ranked_search(docs.limit(2).withColumnRenamed("doc_id", "item_id"), docs).count() == 40
pages = spark.createDataFrame([(1, "http://a.example/", "<p>text</p>")], "page_id long, url string, html string")
assert html.extract_text(pages).first()["text"] == "text"
print("all ran")
"""


def test_operators_run_where_the_package_is_not_installed(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    run = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in run.stdout, run.stderr[-3000:]


def test_ids_before_a_mark_that_the_lower_case_joins():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(tokenizer_path()), WordIds(read_whole(tokenizer_path()))
    texts = ["İ. x", "xİ! z", "İ, İ; İİ?! a", "i̇. x", "ẞ. ß! ŉ, ǰ. ΐ. a"]
    for text, ids in zip(texts, own.encode(texts)):
        assert whole.encode(text, add_special_tokens=False).ids == ids.tolist(), text
