"""Entity resolution: exact and rule keys, text similarity in blocks, clusters, crosswalk."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.scalars import canonical_id, entity_text, geo_score, signature
from lakeq.session import cut, cut_unsized

EXACT, RULE, FUZZY, PROBABLE = 1.0, 0.95, 0.88, 0.82
#: Below this ratio the segments of short texts would be empty.
LEAST_LIKENESS = 0.7
#: Bits of the letters (in 32 groups) that a text has, and 32 higher of those it has twice. Each bit that differs between two texts is an unmatched letter.
LETTER_BAG = "aggregate(split(text, ''), 0L, (m, c) -> m | shiftleft(1L, (ascii(c) & 31) + if((m & shiftleft(1L, ascii(c) & 31)) <> 0L, 32, 0)))"


def resolve_exact(df: DataFrame, entity_type: str, source: str, id_col: str, exact: list[str], rule: list[str]) -> DataFrame:
    """Crosswalk by exact fields where all are there, else by the rule fields, else a new entity of its own."""
    exact_key = signature({c: F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in exact}) if exact else F.lit("")
    full = F.lit(bool(exact))
    for c in exact:
        full = full & (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    rule_key = signature({c: entity_text(F.col(c)) for c in rule})
    method = F.when(full, "exact").when(rule_key != "", "rule_based").otherwise("new_entity")
    key = F.when(full, exact_key).when(rule_key != "", rule_key).otherwise(F.concat(F.lit("id="), F.col(id_col).cast("string")))
    score = F.when(full, EXACT).when(rule_key != "", RULE).otherwise(0.5)
    return df.select(
        F.lit(source).alias("source_system"), F.lit(entity_type).alias("entity_type"), F.col(id_col).cast("string").alias("source_entity_id"),
        canonical_id(entity_type, key).alias("canonical_entity_id"), method.alias("match_method"), score.alias("confidence_score"),
    )


@F.pandas_udf(T.DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, which no built-in computes."""
    return pd.Series([None if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right)], dtype="float64")


def similar_texts(df: DataFrame, id_col: str, text_col: str, threshold: float = FUZZY) -> DataFrame:
    """a < b, ratio of representatives whose normalised texts are alike. No pair is lost; meant for names, not documents.

    Equal texts are folded to one representative (smallest id) before any pairing. A ratio of ``threshold`` leaves at
    most k = (1 - threshold) * (both lengths) letters unmatched. So if the shorter text is cut into more than k
    segments, one of them stands unchanged in the longer text, the n-th of them moved by n places at most. Texts meet
    by (length, number, letters) of a segment; what the letters' counts or the edit distance rule out is dropped in the
    JVM, before the ratio. The number of unmatched letters is even or odd as the sum of the lengths is.

    Estimates take no account of what an explode adds, which is some 60 rows a text here: the hint keeps Spark from
    sending the pieces of a large table through the driver.
    """
    if threshold < LEAST_LIKENESS:
        raise ValueError(f"texts less alike than {LEAST_LIKENESS} share no segment for certain")
    texts = representatives(df, id_col, text_col).withColumn("len", F.length("text")).withColumn("bag", F.expr(LETTER_BAG))
    longest = (2 - threshold) / threshold
    most = lambda c: F.floor((1 - threshold) * (c + F.floor(c * longest + 1e-9)) + 1e-9).cast("int")
    start = lambda n, parts, c: F.floor(n * c / parts).cast("int")
    indexed = texts.withColumn("parts", F.least(most(F.col("len")) + 1, F.col("len"))).withColumn("n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    at, end = start(F.col("n"), F.col("parts"), F.col("len")), start(F.col("n") + 1, F.col("parts"), F.col("len"))
    segments = indexed.select(F.col("rep").alias("ra"), F.col("text").alias("x"), F.col("bag").alias("bag_x"), "len", "n", F.substr("text", at + 1, end - at).alias("piece"))
    shortest = F.ceil(F.col("len") / longest - 1e-9).cast("int")
    lengths = texts.withColumn("other", F.explode(F.sequence(F.greatest(shortest, F.lit(1)), F.col("len"))))
    numbered = lengths.withColumn("parts", F.least(most(F.col("other")) + 1, F.col("other"))).withColumn("n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    p, q = start(F.col("n"), F.col("parts"), F.col("other")), start(F.col("n") + 1, F.col("parts"), F.col("other"))
    moved = numbered.withColumn("p", p).withColumn("size", q - p).withColumn("at", F.sequence(F.greatest(F.col("p") - F.col("n"), F.lit(0)), F.least(F.col("p") + F.col("n"), F.col("len") - F.col("size"))))
    pieces = F.array_distinct(F.transform("at", lambda at: F.substr("text", at + 1, F.col("size"))))
    probes = moved.select(F.col("rep").alias("rb"), F.col("text").alias("y"), F.col("bag").alias("bag_y"), F.col("other").alias("len"), "n", F.explode(pieces).alias("piece"), F.col("len").alias("len_y"))
    met = segments.hint("merge").join(probes, ["len", "n", "piece"]).filter("len < len_y OR ra < rb").filter("ra <> rb")
    both = F.col("len") + F.col("len_y")
    most_unmatched = F.floor((1 - threshold) * both + 1e-9).cast("int")
    room = most_unmatched - F.abs(most_unmatched - both) % 2
    near = met.filter((F.bit_count(F.col("bag_x").bitwiseXOR(F.col("bag_y"))) <= room) & (F.levenshtein("x", "y") <= room)).select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"), "x", "y").dropDuplicates(["a", "b"])
    ordered = near.withColumn("ratio", F.greatest(similarity("x", "y"), similarity("y", "x")))
    return ordered.filter(F.col("ratio") >= threshold).select("a", "b", "ratio")


def representatives(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text, rep (smallest id) of the distinct normalised texts."""
    return df.select(entity_text(F.col(text_col)).alias("text"), F.col(id_col).alias("id")).filter("text <> ''").groupBy("text").agg(F.min("id").alias("rep"))


def clusters(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, cluster (smallest node linked to it). Edges turn into stars around the smallest node, in few rounds.

    Each round links the higher end of an edge to the lowest neighbour of the lower end (large star), then all lower
    neighbours of a node to the lowest of them (small star); both keep what is linked. It ends when each node has one
    lower neighbour at most and that has none.
    """
    links = cut_unsized(edges.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    while links.groupBy("high").count().filter("count > 1").limit(1).count() or links.join(links.select(F.col("low").alias("high")), "high", "left_semi").limit(1).count():
        lower = links.select("high", F.col("low").alias("mid")).join(_lowest(links).withColumnRenamed("high", "mid"), "mid", "left")
        large = cut_unsized(lower.select("high", F.coalesce("lowest", "mid").alias("low")).distinct())
        rest = large.join(_lowest(large), "high").filter("low > lowest").select(F.col("low").alias("high"), F.col("lowest").alias("low"))
        links = cut_unsized(_lowest(large).withColumnRenamed("lowest", "low").unionByName(rest).distinct())
    named = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct().join(links.withColumnRenamed("high", "node"), "node", "left")
    return named.select("node", F.coalesce("low", "node").alias("cluster"))


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("high").agg(F.min("low").alias("lowest"))


def fuzzy_classes(df: DataFrame, id_col: str, text_col: str, threshold: float = FUZZY) -> DataFrame:
    """id, class_id, links: every row with the class of its text and its number of alike other texts."""
    texts = cut_unsized(representatives(df, id_col, text_col))
    links = cut_unsized(similar_texts(df, id_col, text_col, threshold))
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    named = clusters(texts.select("rep"), links).withColumnRenamed("node", "rep")
    by_text = texts.join(named, "rep").join(degree, "rep", "left").select("text", "cluster", F.coalesce("links", F.lit(0)).alias("links"))
    rows = df.select(F.col(id_col), entity_text(F.col(text_col)).alias("text"))
    return rows.join(by_text, "text", "left").select(id_col, F.coalesce("cluster", F.col(id_col)).alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def resolve(df: DataFrame, entity_type: str, source: str, id_col: str, exact: list[str], rule: list[str], text_col: str, place: tuple[str, str] | None = None) -> DataFrame:
    """Crosswalk in tiers: exact fields, rule fields, then likeness of ``text_col``, else a new entity.

    A row that exact and rule fields leave as new joins the class of the alike text with the highest score: fuzzy from
    ``FUZZY``, probabilistic from ``PROBABLE``. The score is the ratio of the texts; with ``place`` (latitude and
    longitude columns) three quarters of it and one quarter of nearness, where both rows have a place.
    """
    crosswalk = resolve_exact(df, entity_type, source, id_col, exact, rule)
    texts = cut(representatives(df, id_col, text_col))
    alike = similar_texts(df, id_col, text_col, PROBABLE)
    links = alike.unionByName(alike.select(F.col("b").alias("a"), F.col("a").alias("b"), "ratio"))
    score = F.col("ratio")
    if place:
        spots = df.select(F.col(id_col).alias("rep"), F.col(place[0]).cast("double").alias("lat"), F.col(place[1]).cast("double").alias("lon")).join(texts.select("rep"), "rep", "left_semi")
        of = lambda side: spots.select(F.col("rep").alias(side), F.col("lat").alias(f"lat_{side}"), F.col("lon").alias(f"lon_{side}"))
        links = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
        near = geo_score(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
        score = F.when(near.isNull(), score).otherwise(0.75 * score + 0.25 * near)
    best = links.withColumn("score", score).filter(F.col("score") >= PROBABLE).groupBy("a").agg(F.max(F.struct("score", -F.col("b").cast("long"))).alias("r")).select(F.col("a").alias("rep"), "r.score", F.expr("-r.col2").alias("partner"))
    rows = df.select(F.col(id_col).cast("string").alias("source_entity_id"), entity_text(F.col(text_col)).alias("text")).join(texts, "text").join(best, "rep")
    tier = rows.select("source_entity_id", "score", F.least("rep", "partner").cast("string").alias("class"))
    joined = crosswalk.join(tier, "source_entity_id", "left")
    taken = (F.col("match_method") == "new_entity") & F.col("score").isNotNull()
    return joined.select(
        "source_system", "entity_type", "source_entity_id",
        F.when(taken, canonical_id(entity_type, F.concat(F.lit("like="), "class"))).otherwise(F.col("canonical_entity_id")).alias("canonical_entity_id"),
        F.when(taken & (F.col("score") >= FUZZY), "fuzzy").when(taken, "probabilistic").otherwise(F.col("match_method")).alias("match_method"),
        F.when(taken, F.round("score", 6)).otherwise(F.col("confidence_score")).alias("confidence_score"),
    )
