import random

from lakeq.operators import orphans
from tests.conftest import rows

CHILD = "sk_accountid long, sk_customerid long, batchid long, key string, period string, refs long"
PARENT = "sk_customerid long, batchid long, alive string"
DELETED = "parent_table string, sk_value long, deleted_batchid long, restored_batchid long, dead string"
REF = orphans.Reference("dim_account", "sk_accountid", "sk_customerid", "dim_customer", "sk_customerid")


def found(spark, child, parent, deleted):
    rows_ = orphans.references(spark.createDataFrame([(*c, "x", "y", 1) for c in child], CHILD), REF)
    parents = {"dim_customer": (spark.createDataFrame([(*p, "z") for p in parent], PARENT), "sk_customerid")}
    deletions = spark.createDataFrame([("dim_customer", *x, "w") for x in deleted], DELETED)
    return {r.child_sk for r in orphans.find_orphans(rows_, parents, deletions).collect()}


def brute(child, parent, deleted):
    out = set()
    for sk, key, batch in child:
        if not key:
            continue
        there = any(p == key and b is not None and batch is not None and b <= batch for p, b in parent)
        gone = any(k == key and a is not None and batch is not None and a <= batch and (b is None or b > batch) for k, a, b in deleted)
        if not there or gone:
            out.add(sk)
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    pick = lambda top: rng.choice([None, 0, *range(1, top)])
    child = [(i, pick(9), pick(6) or None) for i in range(300)] + [(1000 + i, 3, 2) for i in range(300)]
    parent = [(pick(8), rng.choice([None, 1, 2, 3, 4])) for _ in range(12)]
    deleted = [(rng.randint(1, 8), rng.choice([None, 2, 3, 4]), rng.choice([None, 3, 4, 5])) for _ in range(6)]
    child += child[:20]
    # a span that ends before it starts deletes nothing
    deleted = [x for x in deleted if x[1] is None or x[2] is None or x[2] > x[1]]
    assert found(spark, child, parent, deleted) == brute(child, parent, deleted)


def test_edges(spark):
    assert found(spark, [], [], []) == set()
    assert found(spark, [(1, 5, 1), (2, None, 1), (3, 0, 1), (4, 5, None)], [], []) == {1, 4}
    assert found(spark, [(1, 5, 3)], [(5, 1)], [(5, 2, 4), (5, 3, None)]) == {1}
    assert found(spark, [(1, 5, 4)], [(5, 1)], [(5, 2, 4)]) == set()
    assert found(spark, [(1, 5, 4)], [(5, 4), (5, None)], [(5, None, None)]) == set()


def test_counters_run_per_key(spark):
    child = spark.createDataFrame([(1, 7, 1, "", "", 0), (2, 7, 1, "", "", 0), (3, 7, 2, "", "", 0)], CHILD)
    deltas = orphans.reference_deltas(orphans.references(child, REF))
    assert [(r.period, r.refs) for r in orphans.ledger(deltas).orderBy("period").collect()] == [(1, 2), (2, 1), (3, 0)]


def test_report_counts_what_is_found(spark, data):
    from lakeq.plans import problems

    listed = problems.p2_found(spark, data).count()
    counted = sum(r.orphan_rows for r in problems.p2_report(spark, data).collect())
    assert counted >= listed > 0 and rows(problems.p2_found(spark, data).filter("child_sk IS NULL")) == []
