"""History of changing attributes by presence bitmaps.

Each entity's states are hashed; per (entity, hash) one bit is set for every snapshot that shows the state.
Runs of consecutive bits are the validity intervals, gaps fall out as zero bits. Bitmaps are 64-bit words
keyed by word number, so any number of snapshots works; runs that touch a word's edge are joined with the
neighbouring word afterwards. Rows are reduced to one per entity and snapshot by partial aggregation
before any window, so one entity holding a third of all rows is no hot task.

For periodic snapshots the bits stand on a calendar that all entities share, so absence is a gap. For dated changes
nothing says that an entity was absent: its own dates are its snapshots, and its bitmaps have no gaps but those of
other states in between.

``carry`` names columns (attributes, batch) that come with every version: those of the row that began it.

Values are equal after trimming and lower-casing, null equal to ''.

Defined cases
    null entity key, or null snapshot position     ignored
    several rows of an entity in one snapshot      the one with the highest rank counts
    repeated rows                                  change nothing
    empty table                                    empty history
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"
WORD = 64


def state_hash(columns: list[str]) -> Column:
    """Hash of the attributes under the equality above; the position of an empty value counts."""
    values = [F.coalesce(F.lower(F.btrim(F.col(c).cast("string"), F.lit(" \t\r\n"))), F.lit("")) for c in columns]
    return F.xxhash64(*values)


def bitmaps(states: DataFrame) -> DataFrame:
    """entity_key, state, pos -> entity_key, state, word, bits."""
    return (
        states.groupBy("entity_key", "state", F.expr(f"pos div {WORD}").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pos % {WORD} as int))")).alias("bits"))
    )


def runs(bits: DataFrame) -> DataFrame:
    """entity_key, state, word, bits -> entity_key, state, first_pos, last_pos of each run of set bits."""
    starts = F.expr("bits & ~shiftleft(bits, 1)")
    ends = F.expr("bits & ~shiftrightunsigned(bits, 1)")
    positions = lambda mask: F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(mask, i) == 1)
    spans = bits.withColumn("a", positions(starts)).withColumn("b", positions(ends))
    pieces = spans.select(
        "entity_key", "state", F.inline(F.arrays_zip("a", "b")), F.col("word")
    ).select("entity_key", "state", (F.col("word") * WORD + F.col("a")).alias("a"), (F.col("word") * WORD + F.col("b")).alias("b"))
    w = Window.partitionBy("entity_key", "state").orderBy("a")
    islands = pieces.withColumn("new", F.when(F.lag("b").over(w) + 1 == F.col("a"), 0).otherwise(1)).withColumn("island", F.sum("new").over(w))
    return islands.groupBy("entity_key", "state", "island").agg(F.min("a").alias("first_pos"), F.max("b").alias("last_pos")).drop("island")


def snapshot_history(snapshots: DataFrame, entity: str, key: str, attributes: list[str], calendar: DataFrame, period: str = "batchid", rank: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Versions from periodic snapshots: entity, entity_key, valid_from, valid_to, state, and the carried columns.

    ``calendar`` (period, batch_date) lists all snapshots, so an entity absent from one has a gap there.
    A version ends at the date of the next snapshot that differs or lacks the entity.
    """
    positions = calendar_positions(calendar, period)
    latest = (
        snapshots.filter(F.col(key).isNotNull() & F.col(period).isNotNull())
        .groupBy(F.col(key).cast("long").alias("entity_key"), F.col(period).alias("period"))
        .agg(F.max_by(_kept(attributes, carry), F.struct(F.col(rank or period), state_hash(attributes))).alias("r"))
        .select("entity_key", "period", "r.*")
    )
    placed = latest.join(F.broadcast(positions.select("period", "pos")), "period")
    spans = runs(bitmaps(placed.select("entity_key", "state", "pos")))
    begins = F.broadcast(positions.select(F.col("pos").alias("first_pos"), F.col("batch_date").alias("valid_from")))
    closes = F.broadcast(positions.select((F.col("pos") - 1).alias("last_pos"), F.col("batch_date").alias("valid_to")))
    if carry:
        spans = spans.join(placed.select("entity_key", F.col("pos").alias("first_pos"), *carried(carry)), ["entity_key", "first_pos"])
    return (
        spans.join(begins, "first_pos")
        .join(closes, "last_pos", "left")
        .select(F.lit(entity).alias("entity"), "entity_key", "valid_from", F.coalesce("valid_to", F.lit(OPEN_END)).alias("valid_to"), "state", *carried(carry))
    )


def carried(carry: tuple[str, ...]) -> list[Column]:
    return [F.col(f"_carry_{c}") for c in carry]


def _kept(attributes: list[str], carry: tuple[str, ...]) -> Column:
    return F.struct(state_hash(attributes).alias("state"), *[F.col(c).alias(f"_carry_{c}") for c in carry])


def full_versions(history: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """entity_key, effectivedate, enddate, iscurrent and the carried columns of every version."""
    return history.select(
        "entity_key", F.col("valid_from").alias("effectivedate"), F.col("valid_to").alias("enddate"), (F.col("valid_to") == OPEN_END).alias("iscurrent"), *[F.col(f"_carry_{c}").alias(c) for c in carry]
    )


#: Snapshots in a calendar; it is broadcast, so its size is checked.
MAX_SNAPSHOTS = 200_000


def calendar_positions(calendar: DataFrame, period: str) -> DataFrame:
    """period, batch_date, pos: the snapshots in order, numbered from 0."""
    from lakeq.session import bounded_rows

    rows = bounded_rows(calendar.filter(F.col(period).isNotNull()).groupBy(period).agg(F.min("batch_date")), MAX_SNAPSHOTS, "the snapshot calendar")
    numbered = [(int(r[0]), r[1], at) for at, r in enumerate(sorted(rows, key=lambda r: r[0]))]
    return calendar.sparkSession.createDataFrame(numbered, "period long, batch_date string, pos long")


def change_history(changes: DataFrame, entity: str, key: str, attributes: list[str], effective: str = "effectivedate", rank: tuple[str, ...] = ("batchid",), carry: tuple[str, ...] = ()) -> DataFrame:
    """Versions from dated states: entity, entity_key, valid_from, valid_to, state, and the carried columns.

    Of several rows of an entity and date the one with the highest ``rank`` counts. An entity's dates are
    its own snapshots; a version is a run of dates with the same state.
    """
    latest = (
        changes.filter(F.col(key).isNotNull() & F.col(effective).isNotNull())
        .groupBy(F.col(key).cast("long").alias("entity_key"), F.col(effective).cast("string").alias("valid_from"))
        .agg(F.max_by(_kept(attributes, carry), F.struct(*rank, state_hash(attributes))).alias("r"))
        .select("entity_key", "valid_from", "r.*")
    )
    w = Window.partitionBy("entity_key").orderBy("valid_from")
    placed = latest.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    spans = runs(bitmaps(placed.select("entity_key", "state", "pos")))
    begun = spans.join(placed.select("entity_key", F.col("pos").alias("first_pos"), "valid_from", *carried(carry)), ["entity_key", "first_pos"])
    return begun.select(
        F.lit(entity).alias("entity"), "entity_key", "valid_from", F.lead("valid_from", 1, OPEN_END).over(w).alias("valid_to"), "state", *carried(carry)
    )
