"""Personal data replaced by surrogates, in Spark's own expressions.

Every mention found gets a canonical form, so that spellings of one entity agree. Each distinct entity
gets one surrogate of its type and format, drawn from a keyed hash of it. Surrogates that meet, or that equal
an entity of the corpus, are drawn again until all are distinct. Mentions are then written over in
their own spelling: separators, capitals, titles and lengths stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import row_key, spare_name, table
from tallyward.plans.durable import durable

# Titles by gender, and what names are made of.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"]
NEUTRAL = ["Dr", "Prof"]
SYLLABLES = ["ba", "be", "da", "de", "fi", "ga", "ka", "la", "le", "li", "ma", "me", "mi", "na", "ne", "ni", "pa", "ra", "re", "ri", "sa", "se", "si", "ta",
             "te", "ti", "va", "ve", "vi", "za", "ze", "zo"]
CYRILLIC_SYLLABLES = ["ба", "бе", "да", "де", "фи", "га", "ка", "ла", "ле", "ли", "ма", "ме", "ми", "на", "не", "ни", "па", "ра", "ре", "ри", "са", "се",
                      "си", "та", "те", "ти", "ва", "ве", "ви", "за", "зе", "зо"]
GREEK_SYLLABLES = ["βα", "βε", "γα", "δα", "δε", "ζα", "θα", "θε", "κα", "κε", "κι", "λα", "λε", "λι", "μα", "με", "μι", "να", "νε", "νι", "πα", "πε",
                   "πι", "ρα", "ρε", "ρι", "σα", "σε", "σι", "τα", "τε", "τι"]
# What a keyed hash is made with. A secret of the caller, who keeps it to draw the same surrogates again.
DEFAULT_KEY = "change-me"

_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]*[A-Za-z0-9])+",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d)(?!\.\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\d)|(?<![\d-])\d{3}[-.]\d{3}[-.]\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
              r"|(?<=(?i:password|passwd|secret|token|api_key|apikey)[ ]{0,2}[=:][ ]{0,2}[\"']?)(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{8,}",
    "name": rf"(?<![\p{{L}}])(?:{_TITLES})\.? {{1,3}}\p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+){{0,3}}",
}
_ANY = "|".join(_KINDS.values())
_TITLE = rf"^(?:{_TITLES})\.? +"
# A word that may be a name already met in its document, and the ending that is not part of one.
_WORD = r"(?<![\p{L}'-])\p{Lu}[\p{L}'-]+"
_POSSESSIVE = r"'[sS]$"
# Stands between the new mentions of a document while they are one string; no pattern finds it.
_BETWEEN = "\u0000"


def _kind(mention: Column) -> Column:
    """The first kind whose pattern fits the mention as a whole; a secret's surroundings are gone, so it is what is left."""
    found = F.lit("secret")
    for kind, pattern in reversed([k for k in _KINDS.items() if k[0] != "secret"]):
        found = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(found)
    return F.when(mention.rlike("^AKIA[0-9A-Z]{16}$"), F.lit("secret")).otherwise(found)


def _stem(word: Column) -> Column:
    return F.regexp_replace(word, _POSSESSIVE, "")


def _canonical(kind: Column, mention: Column) -> Column:
    """Of a name, ``mention`` is one of its words."""
    return (F.when(kind == "email", F.lower(mention)).when(kind == "name", F.lower(_stem(mention)))
            .when(kind.isin("phone", "card", "ssn", "iban"), F.regexp_replace(mention, r"[^A-Za-z0-9+]", ""))
            .otherwise(mention))


def _gender(mention: Column) -> Column:
    title = F.regexp_extract(mention, rf"^({_TITLES})", 1)
    return F.when(title.isin(FEMALE), F.lit("f")).when(title.isin(MALE), F.lit("m"))


def _draw(digest: Column, i: Column) -> Column:
    """Number 0 to 255 from place ``i`` of a hash of 128 hexadecimal digits; places go round."""
    return F.conv(F.substr(digest, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values)) + 1)


def _other_character(c: Column, number: Column) -> Column:
    small = F.char(97 + number % 26)
    return (F.when(c.rlike("[0-9]"), (number % 10).cast("string")).when(c.rlike("[a-z]"), small).when(c.rlike("[A-Z]"), F.upper(small))
            .when(c.rlike(r"\p{IsCyrillic}"), _pick([chr(x) for x in range(0x430, 0x450)], number))
            .when(c.rlike(r"\p{L}"), small).otherwise(c))


def _luhn_sum(digits: Column) -> Column:
    """Of the digits without the check digit, as an array of characters."""
    size = F.size(digits)

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        doubled = F.when((size - i) % 2 == 1, d * 2).otherwise(d)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.transform(digits, value), F.lit(0), lambda a, x: a + x)


def _check_digit(digits: Column) -> Column:
    return ((10 - _luhn_sum(F.split(digits, "")) % 10) % 10).cast("string")


def _surrogate(kind: Column, canon: Column, gender: Column, digest: Column) -> Column:
    """A canonical form of the same kind and format, from the hash."""
    letters = F.split(canon, "")

    hexadecimal = F.array_join(F.transform(letters, lambda c, i: F.when(
        c.rlike("[0-9]"), (_draw(digest, i) % 10).cast("string")).otherwise(
            F.char(F.when(c.rlike("[A-F]"), F.lit(65)).otherwise(F.lit(97)) + _draw(digest, i) % 6))), "")

    def redrawn(kept: Column) -> Column:
        """All characters drawn anew, but for the first ``kept``."""
        return F.array_join(F.transform(letters, lambda c, i: F.when(i < kept, c).otherwise(_other_character(c, _draw(digest, i)))), "")

    top = F.length(canon) - F.length(F.substring_index(canon, ".", -1))
    email = F.array_join(F.transform(letters, lambda c, i: F.when(i >= top, c).otherwise(_other_character(c, _draw(digest, i)))), "")
    octets = [_draw(digest, F.lit(i)) for i in range(4)]
    ip = F.concat_ws(".", (octets[0] % 223 + 1).cast("string"), *(o.cast("string") for o in octets[1:]))
    card = redrawn(F.lit(1))
    body, own = F.substr(card, F.lit(1), F.length(card) - 1), F.substr(canon, F.lit(1), F.length(canon) - 1)
    card = F.when(F.right(canon, F.lit(1)) == _check_digit(own), F.concat(body, _check_digit(body))).otherwise(card)
    number = [_draw(digest, F.lit(k)) for k in range(4)]

    def spoken(syllables: list[str], female: str, male: str) -> Column:
        ending = F.when(gender == "f", F.lit(female)).when(gender == "m", F.lit(male)).otherwise(F.lit(""))
        return F.concat(*(_pick(syllables, x) for x in number), ending)

    name = (F.when(canon.rlike(r"\p{IsCyrillic}"), spoken(CYRILLIC_SYLLABLES, "на", "но"))
            .when(canon.rlike(r"\p{IsGreek}"), spoken(GREEK_SYLLABLES, "να", "νο")).otherwise(spoken(SYLLABLES, "na", "no")))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "name", name).when(kind == "card", card)
            .when(kind == "phone", redrawn(F.when(canon.startswith("+"), F.lit(2)).otherwise(F.lit(0))))
            .when(kind == "iban", redrawn(F.lit(2)))
            .when((kind == "secret") & canon.rlike("^(?:[0-9a-f]{8,}|[0-9A-F]{8,})$"), hexadecimal)
            .when(canon.rlike("^AKIA"), redrawn(F.lit(4))).otherwise(redrawn(F.lit(0))))


def _rendered(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's spelling."""
    marks = F.split(F.regexp_replace(surrogate, r"[^\p{L}\p{N}]", ""), "")

    def put(state: Column, c: Column) -> Column:
        wordy = c.rlike(r"[\p{L}\p{N}]")
        new = F.get(marks, state["n"])
        new = F.when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)
        return F.struct(F.concat(state["out"], F.when(wordy, F.coalesce(new, F.lit(""))).otherwise(c)).alias("out"),
                        (state["n"] + wordy.cast("int")).alias("n"))

    walked = F.aggregate(F.split(mention, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("n")), put, lambda s: s["out"])
    return F.when(kind == "ip", surrogate).when(kind == "name", _renamed(mention, surrogate)).otherwise(walked)


def _renamed(word: Column, surrogate: Column) -> Column:
    """A name's surrogate with the capitals and the ending of the word."""
    stem = _stem(word)
    new = F.when((F.upper(stem) == stem) & (F.length(stem) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return F.concat(new, F.substr(word, F.length(stem) + 1, F.length(word)))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) for distinct ``entities`` (kind, canon, gender). Surrogates of a kind are distinct and equal
    no entity of the kind; of those that meet, the one with the smallest canonical form stays and others are drawn again."""
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settled, open_ = None, durable(entities.withColumn("surrogate", F.lit(None).cast("string")), "entities")
    known = open_.select("kind", F.col("canon").alias("surrogate"))
    attempt = 0
    while True:
        digest = F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "canon", F.lit(str(attempt))), 512)
        drawn = durable(open_.repartition(tasks, "kind", "canon").withColumn("surrogate", _surrogate(F.col("kind"), F.col("canon"), F.col("gender"), digest)), "drawn")
        taken = known if settled is None else known.union(settled.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        good = durable(first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canon", "surrogate"), "good")
        settled = good if settled is None else durable(settled.union(good), "settled")
        open_ = durable(drawn.join(good.select("kind", "canon"), ["kind", "canon"], "left_anti"), "open")
        if open_.isEmpty():
            return settled
        attempt += 1


def _written_over(text: Column, pattern: str, new: Column) -> Column:
    """``text`` with its matches of ``pattern`` replaced by the values of ``new``, one after the other."""
    parts = F.split(text, pattern, -1)
    return F.array_join(F.transform(parts, lambda s, i: F.concat(s, F.coalesce(F.get(new, i), F.lit("")))), "")


def replace_personal_data(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with surrogates in ``text`` and the number of them, ``n_replaced``.

    E-mail and IP addresses, phone, card, social security and bank account numbers, credentials, and names after a title.
    One entity has one surrogate throughout, different entities have different ones. Each word of a name is an entity, so
    that a full name and its short forms agree; where a document names someone with a title, the words of that name are
    replaced wherever else they stand capitalised in it. Given names take the gender of the title, words the letters of
    their script (Latin, Cyrillic, Greek; others Latin).
    Rows with equal doc_id and text get equal results; null texts stay null with 0; an empty table stays empty; a column
    named n_replaced is replaced, all others stay, whatever their names.
    """
    others = [c for c in docs.columns if c.lower() != "n_replaced"]
    named = [spare_name(n, others) for n in ("_row_a", "_row_b", "_new_text", "_n_new")]
    row, new_text, n_new = named[:2], named[2], named[3]
    keyed = docs.select(*others, *(c.alias(n) for c, n in zip(row_key(), row)))
    found = keyed.select(*row, F.posexplode(F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))).alias("at", "mention"))
    own = F.regexp_replace("mention", _TITLE, "")
    is_name = F.col("kind") == "name"
    words = F.when(is_name, F.split(own, " ")).otherwise(F.array("mention"))
    mentions = durable(
        found.withColumn("kind", _kind(F.col("mention"))).select(
            *row, "at", "kind",
            F.when(is_name, F.substr("mention", F.lit(1), F.length("mention") - F.length(own))).otherwise(F.lit("")).alias("lead"),
            F.when(is_name & (F.size(words) > 1), _gender(F.col("mention"))).alias("gender"), F.posexplode(words).alias("place", "word"))
        .withColumn("gender", F.when(F.col("place") == 0, F.col("gender")))
        .withColumn("canon", _canonical(F.col("kind"), F.col("word"))), "mentions")
    # A name met with several titles takes the gender that comes first by name, if any.
    entities = mentions.groupBy("kind", "canon").agg(F.min("gender").alias("gender"))
    drawn = surrogates(entities, key)
    # One entity may be in a third of all mentions: a sort-merge join, whose large partitions Spark splits.
    replaced = durable(mentions.join(drawn.hint("merge"), ["kind", "canon"]), "replaced")
    before = F.when(F.col("place") == 0, F.concat(F.lit(_BETWEEN), F.col("lead"))).otherwise(F.lit(" "))
    put = replaced.select(*row, "kind", F.struct("at", "place", F.concat(
        before, _rendered(F.col("kind"), F.col("word"), F.col("surrogate"))).alias("new")).alias("put"))
    # All mentions of a document: bounded by its text.
    by_row = put.groupBy(*row).agg(
        F.split(F.array_join(F.sort_array(F.collect_set("put"))["new"], ""), _BETWEEN).alias("new"), F.max(F.col("kind") == "name").alias("has_name"))
    changed = durable(
        keyed.select(*row, "text").join(by_row.hint("shuffle_hash"), row).select(
            *row, _written_over(F.col("text"), _ANY, F.slice("new", F.lit(2), F.size("new"))).alias("text"),
            (F.size("new") - 1).alias("n"), "has_name").dropDuplicates(row), "changed")
    # The words of a document's names, where they stand without a title.
    names = replaced.where(is_name).select(*row, "canon", "surrogate").distinct()
    bare = changed.where("has_name").select(*row, F.posexplode(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))).alias("at", "word"))
    met = bare.withColumn("canon", F.lower(_stem(F.col("word")))).join(names, [*row, "canon"], "left").select(*row, F.struct(
        "at", F.coalesce(_renamed(F.col("word"), F.col("surrogate")), "word").alias("new"), F.col("surrogate").isNotNull().cast("int").alias("one")).alias("put"))
    met = met.groupBy(*row).agg(F.sort_array(F.collect_set("put")).alias("put"))
    final = changed.join(met.hint("shuffle_hash"), row, "left").select(
        *row, F.when(F.col("put").isNull(), F.col("text")).otherwise(_written_over(F.col("text"), _WORD, F.col("put")["new"])).alias(new_text),
        (F.col("n") + F.coalesce(F.aggregate("put", F.lit(0), lambda n, p: n + p["one"]), F.lit(0))).alias(n_new))
    joined = keyed.join(durable(final, "final").hint("shuffle_hash"), row, "left")
    return joined.select(*(F.coalesce(F.col(new_text), F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in others),
                         F.coalesce(F.col(n_new), F.lit(0)).alias("n_replaced"))


def op6_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", F.greatest(F.col("n_replaced"), F.lit(0)).cast("long").alias("n_replaced"))
