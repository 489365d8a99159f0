import math
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeq.llm import mixing
from tests.conftest import rows

DOC = "doc_id long, text string, source string, tokens long, weight string, key string"
TARGET = "mix_name string, source string, target_share double, max_repeats long"


def counter(c):
    return F.coalesce(F.length(c), F.lit(0)).cast("long")


def tables(spark, docs, targets):
    return spark.createDataFrame(targets, TARGET), spark.createDataFrame([(*d, 7, "w", "k") for d in docs], DOC)


def drawn(spark, docs, targets, **k):
    copies, report = mixing.draw(*tables(spark, docs, targets), counter=counter, **k)
    return {(r.mix_name, r.doc_id): r for r in copies.collect()}, {(r.mix_name, r.source): r for r in report.collect()}


def test_draw_keeps_its_promises(spark):
    rng = random.Random(1)
    docs = [(i, "x" * rng.randint(1, 90), rng.choice(["a", "a", "a", "b", "c"])) for i in range(600)]
    targets = [("m", "a", 0.3, 1), ("m", "b", 0.4, 2), ("m", "c", 0.3, 9), ("n", "a", 0.9, 3), ("n", "gone", 0.1, 2), ("n", "b", 0.05, 1)]
    copies, report = drawn(spark, docs, targets)
    total = sum(len(t) for _, t, _ in docs)
    for (mix, source), r in report.items():
        own = {i: len(t) for i, t, s in docs if s == source}
        used = {i: copies[(mix, i)].copies for i in own if (mix, i) in copies}
        assert r.target_tokens == math.floor(r.target_share * total + 1e-6) and r.drawn_tokens == sum(own[i] * n for i, n in used.items())
        assert 0 <= r.shortfall_tokens == r.target_tokens - r.drawn_tokens
        assert not used or max(used.values()) <= r.max_repeats and max(used.values()) - min(used.values() if len(used) == len(own) else [0]) <= 1
        possible = sum(own.values()) * r.max_repeats
        assert r.drawn_tokens == possible if possible <= r.target_tokens else r.shortfall_tokens < 90
    assert abs(sum(r.actual_share for (m, _), r in report.items() if m == "m") - 1) < 1e-9


def test_order_is_that_of_the_keys(spark):
    docs = [(i, "x" * 10, "a") for i in range(400)]
    copies, _ = drawn(spark, docs, [("m", "a", 0.25, 1)])
    keyed = mixing.with_keys(mixing.weighed(tables(spark, docs, [("m", "a", 1.0, 1)])[1], counter), 42).orderBy("key", "doc_id")
    assert {i for _, i in copies} == {r.doc_id for r in keyed.limit(100).collect()}


def test_heavier_documents_come_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("x").alias("text"), F.when(F.col("id") % 2 == 0, 0.2).otherwise(0.8).alias("w"))
    copies, _ = mixing.draw(spark.createDataFrame([("m", "a", 0.1, 1)], TARGET), docs, 7, counter=counter, weight=F.col("w"))
    got = copies.collect()
    assert len(got) == 400 and sum(r.doc_id % 2 for r in got) > 260


@pytest.mark.parametrize("weight", [0.001, 0.1, 0.3, 1.0, 50.0])
def test_no_bucket_takes_a_share_of_its_source(spark, weight):
    """Whatever the weights, the ranks of keys are spread evenly, so no bucket is a hot group."""
    w = F.when(F.col("id") % 3 == 0, weight).otherwise(F.rand(1) + 0.01)
    docs = mixing.with_keys(spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(1).alias("tokens"), w.alias("weight")), 3)
    ranked = mixing.keyed(docs, mixing.weight_classes(docs))
    assert ranked.groupBy("bucket").count().agg(F.max("count")).first()[0] < 60
    assert ranked.groupBy("bucket", "part").count().agg(F.max("count")).first()[0] <= 3
    by_key = [tuple(r) for r in ranked.orderBy("key").select("bucket", "part").collect()]
    assert by_key == sorted(by_key)


def test_draw_in_key_order_with_weights(spark):
    rng = random.Random(4)
    docs = [(i, "x" * rng.randint(1, 9), "a") for i in range(3000)]
    targets, table = tables(spark, docs, [("m", "a", 0.37, 1)])
    weight = (F.col("doc_id") % 7 + 0.05) / 7
    copies = mixing.draw(targets, table, counter=counter, weight=weight)[0]
    budget, taken, expected = math.floor(0.37 * sum(len(t) for _, t, _ in docs) + 1e-6), 0, set()
    for r in mixing.with_keys(mixing.weighed(table, counter, weight), 42).orderBy("key", "doc_id").collect():
        taken += r.tokens
        if taken > budget:
            break
        expected.add(r.doc_id)
    assert {r.doc_id for r in copies.collect()} == expected


def test_weights_that_say_nothing(spark):
    docs = [(i, "xx", "a") for i in range(5)]
    targets, table = tables(spark, docs, [("m", "a", 1.0, 1)])
    weight = F.element_at(F.array(F.lit(None), F.lit(0.0), F.lit(-1.0), F.lit(float("nan")), F.lit(float("inf"))).cast("array<double>"), (F.col("doc_id") + 1).cast("int"))
    assert mixing.draw(targets, table, counter=counter, weight=weight)[0].count() == 5


def test_shares_can_be_held(spark):
    docs = [(i, "x" * 10, "a" if i < 900 else "b") for i in range(1000)]
    targets = [("m", "a", 0.5, 1), ("m", "b", 0.5, 2), ("m", "gone", 0.2, 3)]
    _, report = drawn(spark, docs, targets, hold_shares=True)
    assert report[("m", "b")].drawn_tokens == 2000 and report[("m", "a")].drawn_tokens == 2000 and report[("m", "gone")].drawn_tokens == 0
    _, free = drawn(spark, docs, targets)
    assert free[("m", "a")].drawn_tokens == 5000 and free[("m", "b")].drawn_tokens == 2000


def test_quality_weight(spark):
    texts = ["the market closed higher on friday after a quiet week", "buy buy buy buy buy buy buy buy", "%% 00 11 ## 22 33", "", None, "word " * 50_000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.quality_weight()).collect()]
    assert got[0] > got[1] > got[2] == got[3] == got[4] == 0.1 and got[5] < got[1]


def test_same_seed_same_draw(spark):
    docs = [(i, "x" * (i % 7 + 1), "a") for i in range(200)]
    one, two, other = (set(drawn(spark, docs, [("m", "a", 0.3, 1)], seed=s)[0]) for s in (1, 1, 2))
    assert one == two != other


def test_edges(spark):
    docs = [(1, None, "a"), (2, "xx", None), (3, "xx", "a"), (3, "xx", "a"), (4, "", "a"), (5, "y" * 300_000, "b")]
    targets = [("m", "a", 1.0, 2), ("m", "b", None, 2), ("m", None, 0.5, 1), ("k", "a", 0.5, None), ("k", "b", -1.0, 3), ("d", "b", 0.3, 2), ("d", "b", 0.2, 1)]
    copies, report = drawn(spark, docs, targets)
    assert {k: r.copies for k, r in copies.items()} == {("m", 3): 2}
    assert report[("m", "a")].shortfall_tokens == 300_004 - 4 and report[("k", "a")].drawn_tokens == 0 and report[("d", "b")].target_share == 0.5 and report[("m", None)].drawn_tokens == 0
    empty_copies, empty_report = drawn(spark, [], targets)
    assert empty_copies == {} and all(r.drawn_tokens == 0 for r in empty_report.values())
    assert drawn(spark, docs, []) == ({}, {})


@pytest.mark.skipif(not os.path.exists(mixing.DEFAULT_RANKS), reason="no vocabulary")
def test_tokens_of_the_public_vocabulary(spark):
    count = mixing.token_counter(spark.range(1))
    texts = ["", "hello world", "naïve café", None, " \n\n x"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(count(F.col("t"))).collect()
    assert [r[0] for r in got][:2] == [0, 2] and got[3][0] == 0 and all(r[0] <= 12 for r in got)


def test_whole_table(spark, data):
    copies, report = mixing.draw(spark.read.parquet(f"{data}/mix_targets.parquet"), spark.read.parquet(f"{data}/documents.parquet"))
    assert report.filter("shortfall_tokens < 0 OR most_copies > max_repeats").count() == 0 and report.count() == 18
    assert rows(copies.filter("copies < 1")) == []
