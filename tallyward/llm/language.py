"""Language of a text: the family first, then one-versus-one linear support vector machines within it.

Features are shares of hashed letter sequences of one to three letters, with word ends. The machines
are fitted in numpy on a bounded sample of labelled rows; every row of the input is predicted from its whole text.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import id_bucket, table

# Family of each language code. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["de", "en", "nl", "sv", "da", "no", "nb", "nn", "is"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "bn", "ur", "mr", "gu", "pa", "ne"],
    "semitic": ["ar", "he", "am"],
}
FEATURES = 1 << 13
UNKNOWN = "und"
# Labelled rows a machine is fitted on: at most so many of a language, and of all languages together.
FIT_ROWS = 300
FIT_ROWS_IN_ALL = 6_000
# Places of a row that are not nought, and their counts.
_AT, _N = ">u2", ">u4"
_ROUNDS = 150
_STRICTNESS = 1e-4
_STEEPNESS = 3.0


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes), code)


def _letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def letter_counts(text: str | None, letters: np.ndarray) -> np.ndarray | None:
    """How often each hashed sequence occurs; None without any letter."""
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    known = letters[np.minimum(code, 0xFFFF)]
    if code.max() > 0xFFFF:
        far = code > 0xFFFF
        known = known & ~far
        known[far] = [chr(c).isalpha() for c in code[far].tolist()]
    if not known.any():
        return None
    code = np.where(known, code, np.uint32(0))
    # One mark between words, whatever stands there.
    stay = known.copy()
    stay[1:] |= known[:-1]
    code = np.concatenate([[np.uint32(0)], code[stay], [np.uint32(0)]])
    total = np.zeros(FEATURES, np.int64)
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    value = code
    for n in range(3):
        if n:
            value = value[:-1] * np.uint32(0x01000193) + code[n:]
        total += np.bincount((value * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0x85EBCA6B) >> shift, minlength=FEATURES)
    return total


@dataclass
class LanguageModel:
    """Machines between families and between the languages of a family, one per pair."""

    scale: np.ndarray
    families: dict[str, list[str]] = field(default_factory=dict)
    weights: np.ndarray = None
    bias: np.ndarray = None
    pairs: list[tuple[str, str]] = field(default_factory=list)

    def _winner(self, names: list[str], margin: dict[tuple[str, str], float]) -> tuple[str, float]:
        """The name with the most contests won, then the largest margins; its least margin."""
        if len(names) == 1:
            return names[0], np.inf
        won: dict[str, list[float]] = defaultdict(list)
        for i, a in enumerate(names):
            for b in names[i + 1:]:
                m = margin[a, b]
                won[a].append(m)
                won[b].append(-m)
        best = max(names, key=lambda n: (sum(m > 0 for m in won[n]), sum(won[n]), n))
        return best, min(won[best])

    def predict(self, counts: np.ndarray | None) -> tuple[str, float]:
        if counts is None or not self.families:
            return UNKNOWN, 0.0
        margins = dict(zip(self.pairs, (self.weights @ (counts * self.scale / counts.sum()) + self.bias).tolist())) if self.pairs else {}
        family, sure = self._winner(sorted(self.families), margins)
        lang, within = self._winner(self.families[family], margins)
        return lang, float(1.0 / (1.0 + np.exp(-_STEEPNESS * min(sure, within))))


def _machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine: hinge loss by averaged subgradient steps, both sides weighing the same."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b = np.zeros(x.shape[1]), 0.0
    # Some rows at a time: a matrix as large as x would be the most that the driver holds.
    size = 1.0 / max(1e-9, np.concatenate([(some * some).sum(axis=1) for some in np.split(x, range(64, len(x), 64))]).mean())
    for step in range(1, _ROUNDS + 1):
        wrong = (y * (x @ w + b) < 1) * weight * y
        rate = 20 * size / np.sqrt(step)
        w += rate * (wrong @ x - _STRICTNESS * w)
        b += rate * wrong.sum()
        mean_w += step * w
        mean_b += step * b
    total = _ROUNDS * (_ROUNDS + 1) / 2
    return mean_w / total, mean_b / total


def first_of_each(texts: DataFrame, fit_rows: int) -> DataFrame:
    """Of each lang the ``fit_rows`` rows that come first by ``_a`` and ``_b``. The firsts of groups of tasks are found before
    those of all, so that no task gets the firsts of every other: with n tasks two steps of about the root of n groups each."""
    groups = math.isqrt(max(0, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1)) + 1
    order = [F.col("_a"), F.col("_b")]
    grouped = texts.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
    for keys in (["lang", "_group"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        grouped = grouped.withColumn("_n", rank).where(F.col("_n") <= fit_rows).drop("_n")
    return grouped.drop("_group")


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, fit_rows_in_all: int = FIT_ROWS_IN_ALL) -> LanguageModel:
    """Fit on ``labelled`` (text, lang): of each language the ``fit_rows`` different texts that come first by a hash."""
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("_a"), F.xxhash64(F.lit(1), "text").alias("_b"))
    text = ["lang", "_a", "_b"]
    first = first_of_each(labelled.select(*text).distinct(), fit_rows)
    # Copies of a text are left out only after the choice, so no other texts are moved; first has fit_rows rows of a language.
    some = labelled.join(F.broadcast(first), text).groupBy(*text).agg(F.min("text").alias("text")).select("lang", "text")

    def count(frames: Iterator) -> Iterator:
        letters = _letter_table()
        for batch in frames:
            found = [letter_counts(t, letters) for t in batch.column("text").to_pylist()]
            found = [(np.empty(0, np.int64),) * 2 if c is None else (np.flatnonzero(c), c[np.flatnonzero(c)]) for c in found]
            # Big-endian, so that bytes are in the order of their numbers.
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), *(pa.array([pair[side].astype(kind).tobytes() for pair in found], pa.binary())
                                         for side, kind in enumerate((_AT, _N)))], ["lang", "at", "n"])

    # At most fit_rows rows of a language, each with at most FEATURES counts.
    rows = [r for r in some.mapInArrow(count, "lang string, at binary, n binary").collect() if r["at"]]
    by_lang: dict[str, list] = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["lang"], r["at"], r["n"])):
        by_lang[r["lang"]].append(r)
    keep = max(1, fit_rows_in_all // max(1, len(by_lang)))
    rows = [r for some_rows in by_lang.values() for r in some_rows[:keep]]
    langs = np.array([r["lang"] for r in rows])
    x = np.zeros((len(rows), FEATURES))
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], _AT)] = np.frombuffer(r["n"], _N)
        x[i] /= x[i].sum()
    model = LanguageModel(1.0 / np.sqrt(x.mean(axis=0) + 1e-4) if len(rows) else np.ones(FEATURES))
    x *= model.scale
    for lang in sorted(by_lang):
        model.families.setdefault(family_of(lang), []).append(lang)
    kin = np.array([family_of(lang) for lang in langs])
    found = []
    for names, labels in [(sorted(model.families), kin), *((f, langs) for f in model.families.values())]:
        for i, a in enumerate(names):
            for b in names[i + 1:]:
                some_rows = (labels == a) | (labels == b)
                model.pairs.append((a, b))
                # The rows of all languages are not copied.
                found.append(_machine(x if some_rows.all() else x[some_rows], np.where(labels[some_rows] == a, 1.0, -1.0)))
    if found:
        model.weights, model.bias = np.array([w for w, _ in found]), np.array([b for _, b in found])
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` (text, any other columns) with lang_pred and score; columns with these names are replaced.

    A null text or one without a letter is ``und`` with score 0, as is every text if nothing was learned.
    """
    docs = docs.drop("lang_pred", "score")
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def name(frames: Iterator) -> Iterator:
        letters = _letter_table()
        for batch in frames:
            found = [model.predict(letter_counts(t, letters)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], schema.names)

    return docs.mapInArrow(name, schema)


def held_out():
    return id_bucket("doc_id", 4) == 2


def language_id(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, lang, any other columns) with lang_pred, score and held_out. The machines learn
    from rows that are not held out and have a label; repeated rows are predicted alike; an empty table stays empty."""
    model = fit(docs.where(~held_out()), fit_rows)
    return predict(docs, model).withColumn("held_out", held_out())


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
