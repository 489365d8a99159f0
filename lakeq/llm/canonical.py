"""One form for texts that look the same.

Texts are exploded to positioned code points, which a broadcast table maps to their width-neutral, decomposed,
look-alike-free form; combining marks are put in the order of their classes and recomposed, and the texts
are rebuilt. Equal forms mean: the texts differ at most in width form, encoding of accents or joined letters,
invisible characters, kind of blank or hyphen, or letters of another alphabet with the same shape.

Only the stretches a mapping can touch are exploded to code points (each run of such characters with the
character before it, which may be the base of an accent); the stretches between them travel as one piece, and
texts without any are their own form. The only shuffle is that of the touched texts to their keys.

Kept apart: case, accents, superscripts, circled digits, fractions, quotes, dashes, line breaks, numbers of
blanks, digits against letters.

Defined cases
    null text                form null
    empty text               form empty
    only invisible letters   form empty
    repeated rows            one row per distinct (id, text)
    very long texts          whole, pieces of one text in one task
    empty table              empty; extra columns are dropped
"""

from __future__ import annotations

import functools
import unicodedata as ud
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.session import cut, small_side

# Letters of other alphabets with the shape of a Latin letter (each pair is other, Latin).
GREEK = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo ϲc ϹC ϳj ͿJ"
CYRILLIC = "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ҮY ХX аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ԚQ ԜW ѵv"
ARMENIAN = "օo ՕO"
# Greek capitals with the shape of a Cyrillic one that no Latin letter has.
GREEK_CYRILLIC = "ΓГ ΠП ΦФ"
# Hyphens that look like the ASCII one; format characters that are visible; blanks that are visible.
HYPHENS = "‐‑﹣"
VISIBLE_FORMATS = {*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD}
VISIBLE_BLANKS = {0x1680}
# Invisible code points outside the format category.
INVISIBLE = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}

LOOKALIKES = {pair[0]: pair[1] for pair in " ".join((GREEK, CYRILLIC, ARMENIAN, GREEK_CYRILLIC)).split()}


def _width(text: str) -> str:
    kind, _, parts = ud.decomposition(text).partition(" ")
    return "".join(chr(int(x, 16)) for x in parts.split()) if kind in ("<wide>", "<narrow>") else text


def mapped(char: str) -> str:
    """What one code point becomes before recomposition: '' where it is invisible."""
    code, category = ord(char), ud.category(char)
    if code in INVISIBLE or category == "Cf" and code not in VISIBLE_FORMATS:
        return ""
    if category == "Zs" and code not in VISIBLE_BLANKS:
        return " "
    if char in HYPHENS:
        return "-"
    char = _width(char)
    if ud.category(char[0])[0] == "L" and "LIGATURE" in ud.name(char[0], "") and ud.decomposition(char[0]).startswith("<"):
        char = ud.normalize("NFKD", char)
    return "".join(LOOKALIKES.get(c, c) for c in ud.normalize("NFD", char))


@functools.cache
def mapping() -> tuple[dict[str, str], str]:
    """(code point -> mapped, for all that change; regex class of those that can't stay in a text as they are)."""
    changes, unsafe = {}, []
    for code in range(0x80, 0x110000):
        char = chr(code)
        if ud.category(char) in ("Cn", "Co", "Cs"):
            continue
        to = mapped(char)
        if to != char:
            changes[char] = to
        # Hangul vowels and finals and a few Indic signs have class 0, but join what stands before them.
        joins = ud.combining(char) or 0x1160 < code < 0x1200 or char in _second_starters()
        if joins or ud.normalize("NFC", to) != char:
            unsafe.append(code)
    return changes, _regex_class(unsafe)


#: Categories that are tested as such and not listed; none holds an ASCII letter.
_PROPERTIES = ("Cf", "Mn", "Mc", "Me")
#: Below this code point the class is exact; above, spans with gaps up to ``_GAP`` are merged, which only explodes more.
_EXACT, _GAP = 0x590, 64


def _regex_class(unsafe: list[int]) -> str:
    """A regex for one of ``unsafe``, by few spans. ASCII is ruled out first, which most letters are."""
    spans: list[list[int]] = []
    for code in (c for c in unsafe if ud.category(chr(c)) not in _PROPERTIES):
        if spans and code - spans[-1][1] <= (1 if code < _EXACT else _GAP):
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "(?:(?![\\x00-\\x7F])[" + "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in spans) + "\\p{M}\\p{Cf}])"


@functools.cache
def _second_starters() -> frozenset[str]:
    """Class-0 code points that end some canonical decomposition of two."""
    out = set()
    for code in range(0x80, 0x110000):
        parts = ud.decomposition(chr(code))
        if parts and parts[0] != "<" and len(parts.split()) == 2:
            out.add(chr(int(parts.split()[1], 16)))
    return frozenset(out)


def mapping_table(spark: SparkSession) -> DataFrame:
    """char, to: bounded by the Unicode character set (some 17,000 rows)."""
    return spark.createDataFrame(list(mapping()[0].items()), "char string, to string").coalesce(1)


def _stretch() -> str:
    """A run of code points to map, with the one before it."""
    return f"(?s).?{mapping()[1]}+"


@F.pandas_udf(T.StringType())
def recompose(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Canonical order of combining marks by class, then canonical composition (no built-in does either)."""
    for part in texts:
        yield part.map(lambda t: None if t is None else ud.normalize("NFC", t))


#: Declared so that filters stay above it and it runs once.
recompose = recompose.asNondeterministic()


def text_key(text: Column) -> Column:
    """128 bits of the text; null where it is null."""
    return F.md5(text)


def canonical_form(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_key, form for every distinct (id, text) of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    touched = F.coalesce(F.col("text").rlike(mapping()[1]), F.lit(False))
    plain = texts.filter(~touched).select(id_col, text_key(F.col("text")).alias("text_key"), F.col("text").alias("form"))
    odd = texts.filter(touched).withColumn("text_key", text_key(F.col("text"))).dropDuplicates([id_col, "text_key"])
    between = F.split("text", _stretch(), -1)
    inside = F.regexp_extract_all("text", F.lit(_stretch()), F.lit(0))
    pieces = odd.select(id_col, "text_key", F.posexplode(F.arrays_zip(between.alias("between"), inside.alias("inside"))).alias("piece", "both"))
    code_points = F.when(F.col("both.inside").isNull(), F.array(F.lit(""))).otherwise(F.regexp_extract_all(F.col("both.inside"), F.lit("(?s)."), F.lit(0)))
    points = pieces.select(id_col, "text_key", "piece", F.col("both.between").alias("between"), F.posexplode(code_points).alias("at", "char"))
    joined = points.join(F.broadcast(mapping_table(spark)), "char", "left").withColumn("to", F.coalesce("to", "char"))
    part = F.when(F.col("at") == 0, F.concat("between", "to")).otherwise(F.col("to"))
    rebuilt = joined.groupBy(id_col, "text_key").agg(F.collect_list(F.struct("piece", "at", part.alias("part"))).alias("parts"))
    strings = F.concat_ws("", F.transform(F.array_sort("parts"), lambda p: p["part"]))
    return plain.unionByName(rebuilt.select(id_col, "text_key", recompose(strings).alias("form")))


#: Distinct texts or forms up to this number are broadcast; more are joined by a shuffle.
MAX_BROADCAST_KEYS = 1_000_000


def _salts(spark: SparkSession) -> int:
    """Join partitions over which the documents of one text are spread: grows with the cluster's shuffle partitions."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def _keyed_forms(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    given = docs.filter(F.col(text_col).isNotNull())
    return canonical_form(given, id_col, text_col).select(F.col(id_col).alias("id"), "text_key", text_key(F.col("form")).alias("form_key"))


def text_pairs(forms: DataFrame) -> DataFrame:
    """key_a, key_b: each two distinct texts of one form once, the one with more documents first.

    Documents are counted per text by partial aggregates, so any number of exact copies is one row here.
    """
    texts = cut(forms.groupBy("form_key", "text_key").agg(F.count(F.lit(1)).alias("n")))
    mixed = small_side(cut(texts.groupBy("form_key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("form_key")), MAX_BROADCAST_KEYS)
    several = cut(texts.join(mixed, "form_key"))
    other = several.select("form_key", F.col("text_key").alias("key_b"), F.col("n").alias("n_b"))
    both = several.withColumnRenamed("text_key", "key_a").join(other, "form_key")
    return both.filter("n > n_b OR (n = n_b AND key_a < key_b)").select("key_a", "key_b")


def lookalike_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id_a < doc_id_b: texts that are not identical but have one form.

    Pairs are made of distinct texts; only then the documents of either text are put in their place, which gives
    every pair once. A text with a third of all documents is spread over salts. ``lookalike_classes`` has the same
    links with one row per document.
    """
    forms = cut(_keyed_forms(docs, id_col, text_col))
    pairs = cut(text_pairs(forms))
    used = small_side(cut(pairs.select(F.explode(F.array("key_a", "key_b")).alias("text_key")).distinct()), MAX_BROADCAST_KEYS)
    members = forms.join(used, "text_key", "left_semi").select("id", "text_key").distinct()
    salts = _salts(docs.sparkSession)
    salt = F.pmod(F.hash("id"), F.lit(salts)).alias("salt")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    many = members.select(F.col("id").alias("id_a"), F.col("text_key").alias("key_a"), salt).join(pairs.select("key_a", "key_b", every), ["key_a", "salt"])
    few = members.select(F.col("id").alias("id_b"), F.col("text_key").alias("key_b"), every)
    placed = many.select("id_a", "key_b", F.pmod(F.hash("id_a"), F.lit(salts)).alias("salt")).join(few, ["key_b", "salt"])
    return placed.filter("id_a <> id_b").select(F.least("id_a", "id_b").alias("doc_id_a"), F.greatest("id_a", "id_b").alias("doc_id_b")).distinct()


def lookalike_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its class (smallest id with the form) and whether the class holds unequal texts."""
    forms = canonical_form(docs, id_col, text_col).withColumn("form_key", text_key(F.col("form")))
    classes = forms.filter("form_key IS NOT NULL").groupBy("form_key").agg(
        F.min(id_col).alias("class_id"), (F.min("text_key") != F.max("text_key")).alias("mixed")
    )
    return forms.join(classes, "form_key", "left").select(id_col, "class_id", "mixed")
