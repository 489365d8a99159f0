"""References to records that do not exist, from signed change deltas.

Every (parent table, key) has two running counters over the reporting periods: references (a row that
refers adds 1 in its period and takes it back in the next, since each period brings its own rows) and
existence (+1 when the parent is first delivered, -1 while deleted, +1 when restored). A key with positive
references and no existence in a period is an orphan of that period. Deltas are summed per key and period
before the shuffle, so a key that holds a third of all rows costs one row per period and map task. The
rows behind orphan keys are found by a salted equi-join.

The counters can be kept: ``advance`` adds the deltas of one period to a stored ledger, which holds one row per key
with a count, and the deltas that are due later (references taken back, restorations).

Defined cases
    null or 0 reference             no reference
    null period of a row            before all periods, so nothing exists for it
    null key or period of a parent  delivers nothing
    null deleted_batchid            no deletion; null restored_batchid: deleted for good
    overlapping deletions           deleted while at least one holds
    repeated rows                   the same child row is reported once
    empty tables                    no children: empty; no parents: every reference is an orphan
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one orphan key spread over this many join partitions.
SALTS = 16
BEFORE_ALL = -(2**62)


@dataclass(frozen=True)
class Reference:
    """One foreign-key column of one child table."""

    child_table: str
    child_key: str
    column: str
    parent_table: str
    parent_key: str


def references(child: DataFrame, ref: Reference) -> DataFrame:
    """child_table, child_sk, fk_column, parent_table, key, period of each row that refers."""
    return child.select(
        F.lit(ref.child_table).alias("child_table"),
        F.col(ref.child_key).cast("long").alias("child_sk"),
        F.lit(ref.column).alias("fk_column"),
        F.lit(ref.parent_table).alias("parent_table"),
        F.col(ref.column).cast("long").alias("key"),
        F.coalesce(F.col("batchid").cast("long"), F.lit(BEFORE_ALL)).alias("period"),
    ).filter("key IS NOT NULL AND key <> 0")


def reference_deltas(rows: DataFrame) -> DataFrame:
    """parent_table, key, period, refs, alive, dead: the references of a period, taken back in the next."""
    counted = rows.groupBy("parent_table", "key", "period").agg(F.count(F.lit(1)).alias("n"))
    both = counted.select(
        "parent_table", "key", F.inline(F.array(F.struct(F.col("period"), F.col("n").alias("refs")), F.struct((F.col("period") + 1).alias("period"), (-F.col("n")).alias("refs"))))
    )
    return both.select("parent_table", "key", "period", "refs", F.lit(0).cast("long").alias("alive"), F.lit(0).cast("long").alias("dead"))


def existence_deltas(parent: DataFrame, parent_table: str, parent_key: str) -> DataFrame:
    """+1 in the period that first delivers the key."""
    first = (
        parent.select(F.col(parent_key).cast("long").alias("key"), F.col("batchid").cast("long").alias("period"))
        .filter("key IS NOT NULL AND period IS NOT NULL")
        .groupBy("key")
        .agg(F.min("period").alias("period"))
    )
    return first.select(F.lit(parent_table).alias("parent_table"), "key", "period", F.lit(0).cast("long").alias("refs"), F.lit(1).cast("long").alias("alive"), F.lit(0).cast("long").alias("dead"))


def deletion_deltas(deletions: DataFrame) -> DataFrame:
    """+1 dead from a deletion on, -1 from its restoration on."""
    spans = deletions.select(
        "parent_table", F.col("sk_value").cast("long").alias("key"), F.col("deleted_batchid").cast("long").alias("a"), F.col("restored_batchid").cast("long").alias("b")
    ).filter("key IS NOT NULL AND a IS NOT NULL AND (b IS NULL OR b > a)").distinct()
    edges = spans.select(
        "parent_table", "key", F.inline(F.array(F.struct(F.col("a").alias("period"), F.lit(1).cast("long").alias("dead")), F.struct(F.col("b").alias("period"), F.lit(-1).cast("long").alias("dead"))))
    ).filter("period IS NOT NULL")
    return edges.select("parent_table", "key", "period", F.lit(0).cast("long").alias("refs"), F.lit(0).cast("long").alias("alive"), "dead")


def ledger(deltas: DataFrame) -> DataFrame:
    """Running counters per key and period with a change: refs, alive, dead."""
    summed = deltas.groupBy("parent_table", "key", "period").agg(F.sum("refs").alias("refs"), F.sum("alive").alias("alive"), F.sum("dead").alias("dead"))
    w = Window.partitionBy("parent_table", "key").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return summed.select("parent_table", "key", "period", *[F.sum(c).over(w).alias(c) for c in ("refs", "alive", "dead")])


COUNTS = ("refs", "alive", "dead")
LEDGER = "parent_table string, key long, period long, refs long, alive long, dead long"


def delivery_deltas(delivered: DataFrame, parent_table: str, parent_key: str, period: int) -> DataFrame:
    """+1 for every key that a period delivers; a key exists while its count is positive."""
    keys = delivered.select(F.col(parent_key).cast("long").alias("key")).filter("key IS NOT NULL").distinct()
    zero = F.lit(0).cast("long")
    return keys.select(F.lit(parent_table).alias("parent_table"), "key", F.lit(period).cast("long").alias("period"), zero.alias("refs"), F.lit(1).cast("long").alias("alive"), zero.alias("dead"))


def advance(stored: DataFrame, deltas: DataFrame, period: int) -> DataFrame:
    """The ledger as of ``period``: all that is due is summed into it, what is due later stays; keys without counts go."""
    due = stored.select("parent_table", "key", "period", *COUNTS).unionByName(deltas.select("parent_table", "key", "period", *COUNTS))
    placed = due.withColumn("period", F.greatest("period", F.lit(period).cast("long")))
    summed = placed.groupBy("parent_table", "key", "period").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return summed.filter("refs <> 0 OR alive <> 0 OR dead <> 0")


def orphan_keys(counters: DataFrame) -> DataFrame:
    """parent_table, key, period, refs with positive references and zero existence."""
    return counters.filter("refs > 0 AND (alive <= 0 OR dead > 0)").select("parent_table", "key", "period", "refs")


def find_orphans(rows: DataFrame, parents: dict[str, tuple[DataFrame, str]], deletions: DataFrame | None = None) -> DataFrame:
    """The rows of ``references`` whose parent does not exist in their period."""
    deltas = reference_deltas(rows)
    for name, (parent, key) in parents.items():
        deltas = deltas.unionByName(existence_deltas(parent, name, key))
    if deletions is not None:
        deltas = deltas.unionByName(deletion_deltas(deletions))
    keys = orphan_keys(ledger(deltas)).select("parent_table", "key", "period", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.hash("child_sk", "fk_column"), F.lit(SALTS)))
    return salted.join(keys, ["parent_table", "key", "period", "salt"], "left_semi")
