"""Evaluation texts inside training text, by spaced-seed hashing.

Both sides are brought to the one form of ``canonical``, cut into words (runs of letters and digits, lower case) and
hashed word by word. Fixed masks over ``SPAN`` consecutive words each ignore some of them: the offsets of a span are
dealt into parts, and there is a mask for every choice of ``tolerance`` parts to ignore. So a passage of ``SPAN``
words with up to ``tolerance`` substituted words hits at least one mask, whichever words they are. The corpus is
streamed against the evaluation seeds: up to a checked number they are broadcast as sorted arrays, and all windows of
a batch are hashed and probed at once, so that only hits become rows; beyond that both sides are joined by a shuffle.
Around the hits the overlaps are verified on the words.

Hits are folded before they are gathered: places of an item with one seed become a range, and the diagonals of a
(document, item) the ranges of ``FOLD`` neighbours, so repeated words ("ha ha ha ...") give no product of places. A
range holds all its diagonals, hence none is lost.

Defined cases
    null text or item            holds no words, no hit
    text under ``SPAN`` words    no hit
    repeated rows or copies      each document id is reported once per item
    ties (a passage in several items, an item several times in a text)   one row per (document, item), the longest
    very long texts              whole
    tolerance above 2            refused: no masks are kept for it
    empty tables                 empty
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.llm.canonical import canonical_form
from lakeq.session import cut, small_side

#: Words that a mask covers.
SPAN = 12
#: Substituted words -> parts of a span; a mask ignores as many parts as words may differ.
PARTS = {0: 1, 1: 3, 2: 4}
WORD = r"[\p{L}\p{N}]+"
#: Evaluation seeds up to this number are broadcast (8 bytes each and a bit table).
MAX_BROADCAST_SEEDS = 2_000_000
#: Ids of documents with hits up to this number are broadcast; more are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000
#: Neighbouring diagonals gathered into one range.
FOLD = 64
#: Bits of the table that rules most seeds out before the sorted array is searched.
BITS = 22


def masks(tolerance: int) -> tuple[int, list[tuple[int, ...]]]:
    """(parts, the parts each mask keeps); together the masks cover any ``tolerance`` substitutions."""
    if tolerance not in PARTS:
        raise ValueError(f"no masks for {tolerance} substituted words; known are {sorted(PARTS)}")
    parts = PARTS[tolerance]
    return parts, list(itertools.combinations(range(parts), parts - tolerance))


def words(form: Column) -> Column:
    """The words of a text in the one form."""
    return F.regexp_extract_all(F.lower(form), F.lit(WORD), F.lit(0))


def with_words(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, h: the hashed words of every distinct (id, text)."""
    form = canonical_form(texts.filter(F.col(text_col).isNotNull()), id_col, text_col)
    return form.select(id_col, F.transform(words(F.col("form")), lambda w: F.xxhash64(w)).alias("h"))


def _mixed(values: list[np.ndarray], salt: int) -> np.ndarray:
    """One hash of several columns of hashes."""
    with np.errstate(over="ignore"):
        out = np.full(len(values[0]), 0x9E3779B97F4A7C15 * (salt + 1) % 2**64, np.uint64)
        for v in values:
            out = (out ^ v) * np.uint64(0xFF51AFD7ED558CCD)
            out ^= out >> np.uint64(32)
    return out


def window_seeds(h: np.ndarray, tolerance: int) -> Iterator[np.ndarray]:
    """Per mask, the seed of the window at every place of ``h``.

    The words of one part of a window are hashed once and shared: the part that starts at a window's second word
    is also the first part of the next window.
    """
    parts, kept = masks(tolerance)
    n = len(h) - SPAN + 1
    part = _mixed([h[o : len(h) - SPAN + parts + o] for o in range(0, SPAN, parts)], 0)
    for mask, keep in enumerate(kept):
        yield _mixed([part[r : r + n] for r in keep], mask + 1)


def _probing(id_type: pa.DataType, tolerance: int, known=None):
    """Rows (id, at, mask, seed) of all windows, or of those whose seed is in the broadcast ``known``."""
    names = ["id", "at", "mask", "seed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {}
        if known is not None:
            for mask, seeds in known.value.items():
                bits = np.zeros(1 << BITS, bool)
                bits[seeds >> np.uint64(64 - BITS)] = True
                tables[mask] = (seeds, bits)
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            h = np.asarray(lists.flatten()).view(np.uint64)
            if len(h) < SPAN:
                continue
            lengths = np.asarray(lists.value_lengths())
            ends = np.cumsum(lengths)
            owner = np.repeat(np.arange(len(lengths)), lengths)[: len(h) - SPAN + 1]
            places = np.arange(len(h) - SPAN + 1)
            room = places + SPAN <= ends[owner]
            for mask, seeds in enumerate(window_seeds(h, tolerance)):
                if known is None:
                    at = np.flatnonzero(room)
                elif mask in tables:
                    sorted_seeds, bits = tables[mask]
                    at = np.flatnonzero(bits[seeds >> np.uint64(64 - BITS)] & room)
                    found = np.searchsorted(sorted_seeds, seeds[at])
                    at = at[sorted_seeds[np.minimum(found, len(sorted_seeds) - 1)] == seeds[at]]
                else:
                    continue
                begins = (ends - lengths)[owner[at]]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner[at])).cast(id_type), pa.array(at - begins, pa.int64()), pa.array(np.full(len(at), mask), pa.int32()), pa.array(seeds[at].view(np.int64))], names=names
                )

    return run


def _windows(worded: DataFrame, id_col: str, tolerance: int, known=None) -> DataFrame:
    kind = worded.schema[id_col].dataType
    arrow = worded.sparkSession.createDataFrame([], worded.select(id_col).schema).toArrow().schema.field(0).type
    rows = worded.filter(F.size("h") >= SPAN).select(id_col, "h").mapInArrow(_probing(arrow, tolerance, known), f"id {kind.simpleString()}, at long, mask int, seed long")
    return rows.withColumnRenamed("id", id_col)


def hits(docs: DataFrame, items: DataFrame, tolerance: int = 1, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """doc_id, item_id, low, high: for each seed of a document that an item has, the range of diagonals. Inputs: id, h."""
    item_seeds = cut(_windows(items, item_id, tolerance).groupBy(item_id, "mask", "seed").agg(F.min("at").alias("first"), F.max("at").alias("last")))
    keys = item_seeds.select("mask", "seed").distinct()
    known = None
    if keys.limit(MAX_BROADCAST_SEEDS + 1).count() <= MAX_BROADCAST_SEEDS:
        table = keys.toPandas()
        sorted_by_mask = {int(m): np.sort(part["seed"].to_numpy().view(np.uint64)) for m, part in table.groupby("mask")}
        known = docs.sparkSession.sparkContext.broadcast(sorted_by_mask)
    found = _windows(docs, doc_id, tolerance, known).join(small_side(item_seeds, MAX_BROADCAST_SEEDS), ["mask", "seed"])
    return found.select(doc_id, item_id, (F.col("at") - F.col("last")).alias("low"), (F.col("at") - F.col("first")).alias("high"))


def overlap(doc: np.ndarray, item: np.ndarray, diagonals: Iterator[int], tolerance: int) -> tuple[int, int, int]:
    """(longest run of equal words, words in windows with at most ``tolerance`` others on the best diagonal, others among them)."""
    exact = best = others = 0
    for shift in diagonals:
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        if high - low < SPAN:
            continue
        same = item[low:high] == doc[low + shift : high + shift]
        breaks = np.flatnonzero(~same)
        exact = max(exact, int(np.diff(np.concatenate(([-1], breaks, [len(same)]))).max()) - 1)
        wrong = np.concatenate(([0], np.cumsum(~same)))
        starts = np.flatnonzero(wrong[SPAN:] - wrong[:-SPAN] <= tolerance)
        if len(starts):
            edges = np.zeros(len(same) + 1, np.int64)
            edges[starts] += 1
            edges[starts + SPAN] -= 1
            covered = np.cumsum(edges[:-1]) > 0
            words_ = int(covered.sum())
            if words_ > best:
                best, others = words_, int((covered & ~same).sum())
        if exact == len(item):
            break  # the whole item: no diagonal holds more
    return exact, best, others


def _verify(tolerance: int, id_types: list[pa.DataType]):
    """Overlaps along the diagonals of the hits of one (document, item)."""
    names = ["doc_id", "item_id", "exact_words", "overlap_words", "substituted_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, items, ranges = batch.column(2), batch.column(3), batch.column(4).to_pylist()
            out = []
            for n, spans in enumerate(ranges):
                diagonals = itertools.chain.from_iterable(range(a, b + 1) for a, b in merged(spans))
                out.append(overlap(np.asarray(docs[n].values), np.asarray(items[n].values), diagonals, tolerance))
            columns = [pa.array([r[c] for r in out], pa.int32()) for c in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_types[0]), batch.column(1).cast(id_types[1]), *columns], names=names)

    return run


def merged(spans: list[dict]) -> Iterator[tuple[int, int]]:
    """Disjoint ranges that cover the same diagonals."""
    at = None
    for a, b in sorted((s["low"], s["high"]) for s in spans):
        if at is None:
            at = [a, b]
        elif a <= at[1] + 1:
            at[1] = max(at[1], b)
        else:
            yield tuple(at)
            at = [a, b]
    if at is not None:
        yield tuple(at)


def leaks(documents: DataFrame, items: DataFrame, tolerance: int = 1) -> DataFrame:
    """doc_id, item_id, exact_words, overlap_words, substituted_words of every pair with a hit.

    ``exact_words``: the longest run of equal words. ``overlap_words``: the words in windows of ``SPAN``
    with at most ``tolerance`` substitutions on the best diagonal.
    """
    item_words = cut(with_words(items, "item_id", "item_text"))
    found = hits(with_words(documents, "doc_id", "text"), item_words, tolerance)
    folded = found.groupBy("doc_id", "item_id", F.floor(F.col("low") / FOLD).alias("fold")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pairs = cut(folded.groupBy("doc_id", "item_id").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    hit = small_side(cut(pairs.select("doc_id").distinct()), MAX_BROADCAST_IDS)
    again = with_words(documents.join(hit, "doc_id", "left_semi"), "doc_id", "text")
    both = pairs.join(again.withColumnRenamed("h", "doc_h"), "doc_id").join(item_words.withColumnRenamed("h", "item_h"), "item_id")
    kinds = [documents.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()]
    arrow = [f.type for f in documents.sparkSession.createDataFrame([], f"a {kinds[0]}, b {kinds[1]}").toArrow().schema]
    checked = both.select("doc_id", "item_id", "doc_h", "item_h", "ranges").mapInArrow(
        _verify(tolerance, arrow), f"doc_id {kinds[0]}, item_id {kinds[1]}, exact_words int, overlap_words int, substituted_words int"
    )
    return checked.groupBy("doc_id", "item_id").agg(
        F.max("exact_words").alias("exact_words"), F.max("overlap_words").alias("overlap_words"), F.min("substituted_words").alias("substituted_words")
    )
