"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets an exponential key -ln(u)/w, u from a seeded hash of its id and w its quality weight.
Within a source, documents are taken in key order until the tokens reach the budget; complete epochs of the
source come first, the fraction after them. The order is never sorted in one task: a key's rank (its share of the
keys of its source, by the counted weights) has two digits to the base ``BUCKETS``. Token sums of the first digits are
prefix-summed as a small table, the one bucket per (mix, source) that the budget cuts is divided by the second
digit in the same way, and only the small bucket cut there is ordered document by document.

A source's budget is target_share times the tokens of the whole corpus. A draw never exceeds its budget and
no document is drawn more than max_repeats times; what is missing is reported as shortfall. With ``hold_shares`` all
budgets of a mix shrink alike until the scarcest of its sources that has any tokens can fill its own, so that the
shares hold among the tokens drawn.

The weight is a column or expression; ``quality_weight`` is the default.

Defined cases
    null text                           no tokens, never drawn
    null source                         no mix names it; its tokens count in the total
    repeated rows of a document         one document
    null or negative share, max_repeats 0
    source without documents            nothing drawn, all shortfall
    repeated targets of a mix and source  shares added, the smallest max_repeats
    ties of keys                        by document id
    empty tables                        empty draw; report with all shortfall
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakeq.session import cut, small_side

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary file.
DEFAULT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Base of the two digits of a key's rank.
BUCKETS = 16_384


def token_counter(documents: DataFrame, ranks_path: str = DEFAULT_RANKS, pattern: str = DEFAULT_PATTERN):
    """A vectorised token count; the vocabulary (under 1 MB) is broadcast as read on the driver."""
    with open(ranks_path, "rb") as file:
        ranks = documents.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.value.splitlines())}
        encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for part in texts:
            yield part.map(lambda t: 0 if t is None else len(encoding.encode_ordinary(t)))

    return count.asNondeterministic()


def quality_weight(text: str = "text") -> Column:
    """In [0.1, 1]: the geometric mean of four measures that filters of web text use, each in [0, 1].

    The share of letters and blanks among the characters; of words with a letter; of different words (repetition);
    and how near the mean length of a word is to 3 to 10 letters. Whole texts are measured.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[^\s]+"), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1))
    length = F.length(F.regexp_replace(text, r"\s+", "")) / n
    measures = [
        F.length(F.regexp_replace(text, r"[^\p{L}\s]", "")) / F.greatest(F.length(text), F.lit(1)),
        F.size(F.regexp_extract_all(text, F.lit(r"[^\s]*\p{L}[^\s]*"), F.lit(0))) / n,
        F.size(F.array_distinct(words)) / n,
        F.least(F.lit(1.0), length / 3, 10 / F.greatest(length, F.lit(0.1))),
    ]
    product = measures[0] * measures[1] * measures[2] * measures[3]
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.coalesce(F.pow(product, F.lit(0.25)), F.lit(0.1))))


def weighed(documents: DataFrame, counter=None, weight: Column | None = None) -> DataFrame:
    """doc_id, source, tokens, weight: one row per document. Weights that are null or not above 0 count as the least."""
    counter = counter or token_counter(documents)
    given = quality_weight() if weight is None else weight.cast("double")
    usable = F.when((given > LEAST_WEIGHT) & (given < F.lit(float("inf"))), given).otherwise(F.lit(LEAST_WEIGHT))
    sized = documents.select("doc_id", "source", counter(F.col("text")).alias("tokens"), usable.alias("weight"))
    best = F.max(F.struct("tokens", "weight", "source"))
    return sized.groupBy("doc_id").agg(best.alias("r")).select("doc_id", "r.source", "r.tokens", "r.weight")


#: The least weight, and the classes of weight per doubling whose sizes are counted for the ranks of keys.
LEAST_WEIGHT, CLASSES = 1e-6, 4


def with_keys(docs: DataFrame, seed: int) -> DataFrame:
    """Adds the exponential key of every document."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11).cast("double") + 0.5) / F.lit(float(2**53))
    return docs.withColumn("key", -F.log(u) / F.col("weight"))


def weight_classes(docs: DataFrame) -> DataFrame:
    """source, classes: array of (mean weight, share of the source's documents), a few entries per source."""
    level = F.floor(F.log2("weight") * CLASSES).alias("level")
    counted = docs.groupBy("source", level).agg(F.count(F.lit(1)).alias("n"), F.avg("weight").alias("w"))
    gathered = counted.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("w", "n"))).alias("found"), F.sum("n").alias("total"))
    return gathered.select("source", F.transform("found", lambda c: F.struct(c["w"].alias("w"), (c["n"] / F.col("total")).alias("share"))).alias("classes"))


def keyed(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds the two digits of each key's rank in its source: ``bucket`` and ``part``. A greater key has no lower rank."""
    below = F.aggregate("classes", F.lit(0.0), lambda s, c: s + c["share"] * (1 - F.exp(-c["w"] * F.col("key"))))
    ranked = docs.join(small_side(classes), "source").withColumn("rank", F.least(F.lit(1 - 1e-12), F.greatest(F.lit(0.0), below)) * BUCKETS)
    return ranked.withColumn("bucket", F.floor("rank")).withColumn("part", F.floor((F.col("rank") - F.col("bucket")) * BUCKETS)).drop("rank", "classes")


def plan(targets: DataFrame, docs: DataFrame, total: int | None = None, hold_shares: bool = False) -> DataFrame:
    """mix_name, source, target_share, max_repeats, target_tokens, source_tokens, epochs, rest."""
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    if total is None:
        total = docs.agg(F.sum("tokens")).first()[0] or 0
    wanted = targets.groupBy("mix_name", "source").agg(
        F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"),
        F.min(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats"),
    )
    sized = wanted.join(sizes, "source", "left").withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)))
    budget = F.col("target_share") * F.lit(total)
    if hold_shares:
        capacity = F.col("source_tokens") * F.col("max_repeats")
        room = F.when((capacity > 0) & (budget > 0), capacity / budget)
        budget = budget * F.least(F.lit(1.0), F.coalesce(F.min(room).over(Window.partitionBy("mix_name")), F.lit(1.0)))
    return (
        sized.withColumn("target_tokens", F.floor(budget + F.lit(1e-6)))
        .withColumn("epochs", F.least("max_repeats", F.coalesce(F.floor(F.try_divide("target_tokens", "source_tokens")), F.lit(0))))
        .withColumn("rest", F.when(F.col("epochs") < F.col("max_repeats"), F.col("target_tokens") - F.col("epochs") * F.col("source_tokens")).otherwise(0))
    )


def _cut_at(sums: DataFrame, group: list[str], digit: str) -> DataFrame:
    """Per mix and source: the first value of ``digit`` that ``rest`` does not fill, and the tokens before it.

    ``sums``: mix_name, source, digit, tokens, rest, ordered by the digit in a small table (``BUCKETS`` rows a group).
    """
    w = Window.partitionBy(*group).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
    upto = sums.withColumn("before", F.sum("tokens").over(w) - F.col("tokens"))
    return upto.filter("before < rest").groupBy("mix_name", "source").agg(F.max_by(digit, "before").alias(f"cut_{digit}"), F.max("before").alias(f"before_{digit}"))


def draw(
    targets: DataFrame, documents: DataFrame, seed: int = 42, total: int | None = None, counter=None, weight: Column | None = None, hold_shares: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(copies, report). copies: mix_name, source, doc_id, tokens, copies. report: a row per (mix, source)."""
    docs = cut(with_keys(weighed(documents, counter, weight), seed).filter("source IS NOT NULL OR tokens > 0"))
    goals = cut(plan(targets, docs, total, hold_shares))
    usable = docs.filter("tokens > 0 AND source IS NOT NULL")
    ranked = keyed(usable, cut(weight_classes(usable)))
    by_mix = ["mix_name", "source"]
    wanted = goals.select(*by_mix, "max_repeats", "epochs", "rest").filter("source IS NOT NULL")
    sums = ranked.groupBy("source", "bucket").agg(F.sum("tokens").alias("tokens"))
    first = cut(wanted.join(_cut_at(wanted.join(sums, "source"), by_mix, "bucket"), by_mix, "left"))
    near = small_side(first)
    # the bucket that the budget cuts, by the second digit
    inner = ranked.join(near, "source").filter("bucket = cut_bucket")
    parts = inner.groupBy(*by_mix, "part", (F.col("rest") - F.col("before_bucket")).alias("rest")).agg(F.sum("tokens").alias("tokens"))
    goals_cut = cut(first.join(_cut_at(parts, by_mix, "part"), by_mix, "left"))
    pool = ranked.join(small_side(goals_cut), "source")
    below = (F.col("bucket") < F.col("cut_bucket")) | ((F.col("bucket") == F.col("cut_bucket")) & (F.col("part") < F.col("cut_part")))
    at_edge = (F.col("bucket") == F.col("cut_bucket")) & (F.col("part") == F.col("cut_part"))
    clear = pool.filter(~F.coalesce(at_edge, F.lit(False))).withColumn("extra", F.when(below, 1).otherwise(0))
    order = Window.partitionBy(*by_mix).orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("before_bucket") + F.col("before_part") + F.sum("tokens").over(order)
    edge = pool.filter(at_edge).withColumn("extra", F.when(reached <= F.col("rest"), 1).otherwise(0))
    columns = ["mix_name", "source", "doc_id", "tokens", (F.col("epochs") + F.col("extra")).cast("long").alias("copies")]
    copies = clear.select(*columns).unionByName(edge.select(*columns)).filter("copies > 0")
    return copies, report(goals, copies)


def report(goals: DataFrame, copies: DataFrame) -> DataFrame:
    """Shares reached, of all tokens drawn for the mix, and what is missing."""
    drawn = copies.groupBy("mix_name", "source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("drawn_tokens"), F.count(F.lit(1)).alias("drawn_docs"), F.max("copies").alias("most_copies")
    )
    mix = Window.partitionBy("mix_name")
    full = goals.join(drawn, ["mix_name", "source"], "left").na.fill(0, ["drawn_tokens", "drawn_docs", "most_copies"])
    return full.select(
        "mix_name", "source", "target_share", "max_repeats", "source_tokens", "target_tokens", "epochs", "drawn_tokens", "drawn_docs", "most_copies",
        F.coalesce(F.try_divide("drawn_tokens", F.sum("drawn_tokens").over(mix)), F.lit(0.0)).alias("actual_share"),
        (F.col("target_tokens") - F.col("drawn_tokens")).alias("shortfall_tokens"),
    )
