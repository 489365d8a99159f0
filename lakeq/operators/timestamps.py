"""Mixed timestamp formats and zones, read by Viterbi over each source's record order.

Every text gets the array of its valid readings (``functions.temporal``). All records of a source, in their
order, form a chain of states; those already in the normal form are states with one reading. A path pays each
reading's prior, ``SWITCH`` where a slash date has another order of day and month than the slash date before it
in the source (the order is carried over the records between), and ``BACKWARD`` where time runs backwards from
one record to the next. The cheapest path gives each record its reading. What a feed registers is a prior that
outweighs the two transitions of a record (``AGAINST``), so it decides where it speaks; the path decides elsewhere.

No chain is run in one task: it is cut into blocks of record numbers. Each block is reduced to the costs between
the states at its ends (a min-plus matrix); matrices are folded ``FAN`` at a time, level by level, until a source
has one group; then every level is traced back from the ends found above it, down to the records. Inside a block
only the records with a choice, the slash dates and their neighbours are looked at: between two records without a
choice all costs are constant.

Defined cases
    null text                      no reading, norm null
    no valid reading               norm null, no state of the chain
    unknown or null feed           UTC, no convention: the path decides
    local time that occurs twice   two readings, the first by its prior; skipped: read with the offset before the change
    ties of paths                  the first reading in the fixed order of formats
    repeated records               each gets a reading; records with one number are ordered by their text
    null record number             before all others, ordered by a hash of the text
    empty tables                   empty
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.functions import temporal
from lakeq.functions.temporal import BACKWARD, SWITCH

#: Records of a block, about; record numbers without order are spread over ``LOOSE`` blocks.
BLOCK, LOOSE = 8192, 4096
#: A block may span this many times the numbers, for sources that share them with others.
SHARED = 8
#: Blocks folded into one.
FAN = 1024
CHAIN = ["src_table", "feed"]
FIRST_NUMBER = -(2**62)


def source_rows(table: DataFrame, name: str, text: str, kind: str) -> DataFrame:
    """src_table, feed, rec_id, text, kind ('instant' or 'date') of one table."""
    return table.select(
        F.lit(name).alias("src_table"), F.coalesce("feed_code", F.lit("")).alias("feed"), F.col("rec_id").cast("long").alias("rec_id"),
        F.col(text).cast("string").alias("text"), F.lit(kind).alias("kind"),
    )


# -- the chain inside a block --------------------------------------------------------------------------


class Points:
    """The records of a block that a path can tell apart, with the first and the last one.

    ``readings[n]`` are the (instant, order) of point n, order 0 for day first, 1 for month first, -1 for none;
    ``steps[n]`` is None where the next point is the next record, else the instants after n and before n + 1.
    """

    def __init__(self, block: pa.Table):
        order = pc.sort_indices(block, sort_keys=[("rec_id", "ascending"), ("text", "ascending")], null_placement="at_start")
        choice = pc.is_valid(block["alts"].take(order))
        readable = pc.or_(pc.is_valid(block["t"].take(order)), choice)
        self.rows = np.asarray(order)[np.asarray(readable)]
        at = pa.array(self.rows)
        self.choice = np.asarray(pc.is_valid(block["alts"].take(at)))
        times = np.asarray(pc.fill_null(block["t"].take(at), 0))
        fmt = pc.fill_null(block["fmt"].take(at), "")
        slash = np.where(np.asarray(pc.equal(fmt, "day/month")), 0, np.where(np.asarray(pc.equal(fmt, "month/day")), 1, -1))
        told = self.choice | (slash >= 0)
        if len(told):
            told[0] = told[-1] = True
        self.places = np.flatnonzero(told)
        self.alts = iter(block["alts"].take(pa.array(self.rows[self.choice])).to_pylist())
        self.readings, self.priors, self.picked = [], [], []
        for n in self.places.tolist():
            if self.choice[n]:
                alts = next(self.alts)
                self.readings.append([(a["t"], {"day/month": 0, "month/day": 1}.get(a["fmt"], -1)) for a in alts])
                self.priors.append([a["prior"] for a in alts])
                self.picked.append(alts)
            else:
                self.readings.append([(int(times[n]), int(slash[n]))])
                self.priors.append([0.0])
                self.picked.append(None)
        gaps = zip(self.places[:-1].tolist(), self.places[1:].tolist())
        self.steps = [None if b == a + 1 else (int(times[a + 1]), int(times[b - 1])) for a, b in gaps]

    def __len__(self) -> int:
        return len(self.readings)


def _enter(readings, priors, a: int, order: int) -> list[float]:
    """Costs of the states (reading, order) of a first point entered by reading ``a`` with ``order`` carried in."""
    out = [math.inf] * (2 * len(readings))
    own = readings[a][1]
    out[2 * a + (order if own < 0 else own)] = priors[a] + (SWITCH if own not in (-1, order) else 0.0)
    return out


def _step(costs: list[float], readings, step, to, priors) -> tuple[list[float], list[int]]:
    """Costs of the next point's states and the state before each. State: 2 * reading + order carried."""
    out, back = [math.inf] * (2 * len(to)), [0] * (2 * len(to))
    for s, c in enumerate(costs):
        if c == math.inf:
            continue
        t, carried = readings[s >> 1][0], s & 1
        if step is not None and t > step[0]:
            c += BACKWARD
        for b, (u, own) in enumerate(to):
            cost = c + priors[b]
            if (t > u) if step is None else (step[1] > u):
                cost += BACKWARD
            if own < 0:
                state = 2 * b + carried
            else:
                state = 2 * b + own
                if own != carried:
                    cost += SWITCH
            if cost < out[state]:
                out[state], back[state] = cost, s
    return out, back


def _matrix(points: Points) -> list[float]:
    """Cheapest costs from each entry (reading of the first record, order carried in) to each state of the last one, flat."""
    out: list[float] = []
    for a in range(len(points.readings[0])):
        for order in (0, 1):
            costs = _enter(points.readings[0], points.priors[0], a, order)
            for n in range(1, len(points)):
                costs, _ = _step(costs, points.readings[n - 1], points.steps[n - 1], points.readings[n], points.priors[n])
            out += costs
    return out


NODE = pa.schema(
    [("src_table", pa.string()), ("feed", pa.string()), ("block", pa.int64()), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("costs", pa.list_(pa.float64()))]
)
NODE_SQL = "src_table string, feed string, block long, first array<long>, last array<long>, costs array<double>"
ENDS = pa.schema([("src_table", pa.string()), ("feed", pa.string()), ("block", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32())])
ENDS_SQL = "src_table string, feed string, block long, entry int, exit int"
READ = pa.schema([("src_table", pa.string()), ("feed", pa.string()), ("rec_id", pa.int64()), ("text", pa.string()), ("is_date", pa.bool_()), ("fmt", pa.string()), ("t", pa.int64())])
READ_SQL = "src_table string, feed string, rec_id long, text string, is_date boolean, fmt string, t long"


def _summarise(block: pa.Table) -> pa.Table:
    """One node: the instants of a block's first and last record's readings and the costs between their states."""
    points = Points(block)
    if not len(points):
        return NODE.empty_table()
    ends = ([t for t, _ in points.readings[0]], [t for t, _ in points.readings[-1]])
    head = [block[c][0].as_py() for c in ("src_table", "feed", "block")]
    return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip([*head, *ends, _matrix(points)], NODE)], schema=NODE)


def _trace(block: pa.Table, ends: pa.Table) -> pa.Table:
    """The reading of every spelled record of a block, given the states at its ends."""
    fmt, t = block["fmt"], block["t"]
    if block.num_rows and pc.any(pc.is_valid(block["alts"])).as_py():
        points = Points(block)
        entry, at = ends["entry"][0].as_py(), ends["exit"][0].as_py()
        costs = _enter(points.readings[0], points.priors[0], entry >> 1, entry & 1)
        backs = []
        for n in range(1, len(points)):
            costs, back = _step(costs, points.readings[n - 1], points.steps[n - 1], points.readings[n], points.priors[n])
            backs.append(back)
        picks = {}
        for n in range(len(points) - 1, -1, -1):
            if points.picked[n] is not None:
                picks[int(points.rows[points.places[n]])] = points.picked[n][at >> 1]
            at = backs[n - 1][at] if n else at
        mask = np.zeros(block.num_rows, bool)
        mask[list(picks)] = True
        rows = sorted(picks)
        fmt = pc.replace_with_mask(fmt.combine_chunks(), pa.array(mask), pa.array([picks[r]["fmt"] for r in rows], pa.string()))
        t = pc.replace_with_mask(t.combine_chunks(), pa.array(mask), pa.array([picks[r]["t"] for r in rows], pa.int64()))
    out = pa.Table.from_arrays([block["src_table"], block["feed"], block["rec_id"], block["text"], block["is_date"], fmt, t], names=READ.names).cast(READ)
    return out.filter(pc.is_valid(out["text"]))


# -- the chain of blocks -------------------------------------------------------------------------------


class Nodes:
    """Blocks of one source in order, with the cheapest way to every state at the end of each."""

    def __init__(self, part: pa.Table):
        self.part = part.sort_by([("block", "ascending")])
        self.first = [np.asarray(x) for x in self.part["first"].to_pylist()]
        self.last = [np.asarray(x) for x in self.part["last"].to_pylist()]
        self.costs = [np.asarray(c, float).reshape(len(a), 2, len(z), 2) for c, a, z in zip(self.part["costs"].to_pylist(), self.first, self.last)]

    def entered(self, costs: np.ndarray, n: int) -> np.ndarray:
        """[..., reading before, order] -> [..., reading before, reading, order] at the entry of block n."""
        back = BACKWARD * (self.last[n - 1][:, None] > self.first[n][None, :])
        return costs[..., :, None, :] + back[:, :, None]

    def folded(self) -> np.ndarray:
        """The costs from the states at the first block's entry to those at the last block's end."""
        costs = self.costs[0]
        for n in range(1, len(self.costs)):
            entry = self.entered(costs, n).min(axis=2)  # first reading, order, reading, order
            costs = (entry[..., None, None] + self.costs[n]).min(axis=(2, 3))
        return costs

    def traced(self, entry: int | None, at: int | None) -> list[tuple[int, int]]:
        """The states at the entry and the end of every block, from the outer ones (free where None)."""
        start = np.zeros(self.costs[0].shape[:2]) if entry is None else np.full(self.costs[0].shape[:2], np.inf)
        if entry is not None:
            start[entry >> 1, entry & 1] = 0.0
        came, chosen = [], []
        for n, node in enumerate(self.costs):
            if n:
                ways = self.entered(costs, n)
                came.append(ways.argmin(axis=0))
                start = ways.min(axis=0)
            total = (start[:, :, None, None] + node).reshape(start.size, -1)
            chosen.append(total.argmin(axis=0))
            costs = total.min(axis=0)
            costs = (costs - costs.min()).reshape(len(self.last[n]), 2)
        out, at = [], int(costs.argmin()) if at is None else at
        for n in range(len(self.costs) - 1, -1, -1):
            entry = int(chosen[n][at])
            out.append((entry, at))
            if n:
                at = 2 * int(came[n - 1][entry >> 1, entry & 1]) + (entry & 1)
        return out[::-1]


def _fold(part: pa.Table) -> pa.Table:
    """The nodes of a group of blocks as one, numbered by the group."""
    nodes = Nodes(part)
    head = [part["src_table"][0].as_py(), part["feed"][0].as_py(), part["above"][0].as_py()]
    values = [*head, nodes.first[0].tolist(), nodes.last[-1].tolist(), nodes.folded().ravel().tolist()]
    return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(values, NODE)], schema=NODE)


def _ends_table(nodes: Nodes, states: list[tuple[int, int]]) -> pa.Table:
    columns = [nodes.part["src_table"], nodes.part["feed"], nodes.part["block"], pa.array([a for a, _ in states], pa.int32()), pa.array([z for _, z in states], pa.int32())]
    return pa.Table.from_arrays(columns, names=ENDS.names).cast(ENDS)


def _top(part: pa.Table) -> pa.Table:
    nodes = Nodes(part)
    return _ends_table(nodes, nodes.traced(None, None))


def _below(part: pa.Table, ends: pa.Table) -> pa.Table:
    if not part.num_rows:
        return ENDS.empty_table()
    nodes = Nodes(part)
    return _ends_table(nodes, nodes.traced(ends["entry"][0].as_py(), ends["exit"][0].as_py()))


def chain_ends(nodes: DataFrame, levels: int) -> DataFrame:
    """src_table, feed, block, entry, exit of all nodes on the cheapest path of their source; ``levels`` folds lie between."""
    if levels == 0:
        return nodes.groupBy(*CHAIN).applyInArrow(_top, ENDS_SQL)
    grouped = nodes.withColumn("above", F.expr(f"block div {FAN}"))
    over = chain_ends(grouped.groupBy(*CHAIN, "above").applyInArrow(_fold, NODE_SQL), levels - 1)
    return grouped.groupBy(*CHAIN, "above").cogroup(over.withColumnRenamed("block", "above").groupBy(*CHAIN, "above")).applyInArrow(_below, ENDS_SQL)


# -- rows ----------------------------------------------------------------------------------------------


def is_normal() -> Column:
    text = F.col("text")
    return F.when(F.col("kind") == "date", text.rlike(temporal.NORMAL_DATE)).otherwise(text.rlike(temporal.NORMAL_INSTANT))


def normal_time() -> Column:
    """The order value of a text in normal form: UTC microseconds, or midnight of the date; null where there is none."""
    day = F.unix_date(F.substring("text", 1, 10).try_cast("date")).cast("long") * temporal.DAY
    clock = [F.substring("text", at, n).try_cast("long") for at, n in ((12, 2), (15, 2), (18, 2), (21, 6))]
    hour, minute, second, micro = clock
    return F.when(F.col("kind") == "date", day).when(
        (hour < 24) & (minute < 60) & (second < 60), day + ((hour * 60 + minute) * 60 + second) * 1_000_000 + micro
    )


def block_plan(rows: DataFrame) -> tuple[dict[str, int], int]:
    """(record numbers of a block per table, folds between blocks and chain), from one pass over the numbers.

    The width follows from the spread of the middle nine tenths, so a few far numbers only make further blocks.
    """
    stats = rows.groupBy("src_table").agg(
        F.count("rec_id").alias("n"), F.count_if(F.col("rec_id").isNull()).alias("loose"), F.min("rec_id").alias("low"), F.max("rec_id").alias("high"),
        F.percentile_approx("rec_id", F.array(F.lit(0.05), F.lit(0.95)), F.lit(1000)).alias("middle"), F.approx_count_distinct("feed").alias("feeds"),
    ).collect()  # one row per table
    widths, blocks = {}, 1
    for r in stats:
        spread = (r["middle"][1] - r["middle"][0] + 1) / (0.9 * r["n"]) if r["n"] else 1
        widths[r["src_table"]] = max(1, int(BLOCK * min(SHARED, r["feeds"]) * max(spread, 1 / BLOCK)))
        if r["n"]:
            blocks = max(blocks, LOOSE * (r["loose"] > 0) + (r["high"] - r["low"]) // widths[r["src_table"]] + 2)
        elif r["loose"]:
            blocks = max(blocks, LOOSE)
    levels = 0
    while blocks > FAN:
        blocks, levels = -(-blocks // FAN), levels + 1
    return widths, levels


def chain_rows(rows: DataFrame, zones: DataFrame, widths: dict[str, int]) -> DataFrame:
    """src_table, feed, block, rec_id, text, is_date, fmt, t, alts: the states of the chain.

    A record with one reading has ``fmt`` and ``t`` (its order value), one with several has them in ``alts``; the
    text is null where it already has the normal form.
    """
    width = F.lit(BLOCK).cast("long")
    for name, numbers in widths.items():
        width = F.when(F.col("src_table") == name, F.lit(numbers).cast("long")).otherwise(width)
    loose = F.lit(FIRST_NUMBER).cast("long") + F.pmod(F.xxhash64("text"), F.lit(LOOSE))
    placed = rows.filter("text IS NOT NULL").withColumn("block", F.when(F.col("rec_id").isNull(), loose).otherwise(F.call_function("div", F.col("rec_id"), width)))
    keys = ["src_table", "feed", "block", "rec_id"]
    is_date = (F.col("kind") == "date").alias("is_date")
    none = F.lit(None).cast("array<struct<fmt:string,t:bigint,prior:double>>").alias("alts")
    plain = placed.filter(is_normal()).select(*keys, F.lit(None).cast("string").alias("text"), is_date, F.lit(None).cast("string").alias("fmt"), normal_time().alias("t"), none)
    feeds = F.broadcast(temporal.feed_table(zones).withColumnRenamed("feed_code", "feed"))
    zoned = placed.filter(~is_normal()).join(feeds, "feed", "left").withColumn("zone_name", F.coalesce("zone_name", F.lit("UTC")))
    zoned = zoned.withColumn("abbreviations", F.coalesce("abbreviations", F.create_map().cast("map<string,int>")))
    read = temporal.with_readings(zoned, folds=F.col("kind") != "date")
    value = lambda r: F.when(F.col("kind") == "date", r["day"] * temporal.DAY).otherwise(r["instant"])
    read = read.withColumn("readings", F.transform("readings", lambda r: F.struct(r["fmt"].alias("fmt"), value(r).alias("t"), r["prior"].alias("prior"))))
    one = F.when(F.size("readings") == 1, F.get("readings", 0))
    spelled = read.select(*keys, "text", is_date, one["fmt"].alias("fmt"), one["t"].alias("t"), F.when(F.size("readings") > 1, F.col("readings")).alias("alts"))
    return spelled.unionByName(plain)


def normalise_spelled(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """src_table, feed, rec_id, text, fmt, norm of the texts not in normal form; norm is null where none is valid."""
    widths, levels = block_plan(rows)
    # no filter on the readings: it would be pushed below their projections and repeat them
    blocks = chain_rows(rows, zones, widths).repartition(*CHAIN, "block")
    ends = chain_ends(blocks.groupBy(*CHAIN, "block").applyInArrow(_summarise, NODE_SQL), levels)
    read = blocks.groupBy(*CHAIN, "block").cogroup(ends.groupBy(*CHAIN, "block")).applyInArrow(_trace, READ_SQL)
    norm = F.when(F.col("is_date"), temporal.date_text(F.floor(F.col("t") / temporal.DAY))).otherwise(temporal.instant_text(F.col("t")))
    return read.select("src_table", "feed", "rec_id", "text", "fmt", norm.alias("norm"))


def normalise(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """As ``normalise_spelled`` for all rows; texts in normal form keep it if they are valid."""
    already = rows.filter(F.col("text").isNull() | is_normal())
    kept = already.select("src_table", "feed", "rec_id", "text", F.when(F.col("text").isNotNull(), F.lit("normal")).alias("fmt"), F.when(normal_time().isNotNull(), F.col("text")).alias("norm"))
    return normalise_spelled(rows, zones).unionByName(kept)
