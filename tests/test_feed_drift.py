import json

import pytest

from lakeq.operators import feed_drift as fd

RECORD = "rec_id long, source_name string, channel string, file_name string, file_seq long, payload string, field string, place string"
SCHEMA = [("t", "id", "integer", True), ("t", "price", "number", False), ("t", "name", "string", False), ("t", "flag", "integer", False)]


def drift(spark, files, schema=SCHEMA):
    """files: (channel, seq, [records])"""
    given, n = [], 0
    for channel, seq, records in files:
        for r in records:
            n += 1
            given.append((n, "t", channel, f"{channel}_{seq}", seq, r if r is None or isinstance(r, str) else json.dumps(r), "x", "y"))
    return fd.Drift(spark.createDataFrame(given, RECORD), spark.createDataFrame(schema, "source_name string, field_name string, field_type string, is_key boolean"))


def changes(spark, files, schema=SCHEMA):
    return {tuple(r) for r in drift(spark, files, schema).changes().select("file_name", "change_kind", "field_name", "candidate_field").collect()}


def rec(i, **k):
    return {"id": i, "price": i + 0.5, "name": f"n{i}", "flag": i % 2} | k


def moved(i, old, new, wrap=lambda v: v, **k):
    r = rec(i, **k)
    r[new] = wrap(r.pop(old))
    return r


def test_rename_with_another_type_holds_and_ends(spark):
    files = [
        ("a", 1, [rec(1), rec(2)]),
        ("a", 2, [moved(2, "price", "cost", str), moved(3, "price", "cost", str)]),
        ("a", 4, [moved(9, "price", "cost")]),
        ("a", 5, [rec(10)]),
        ("a", 6, [moved(11, "price", "cost")]),
    ]
    assert changes(spark, files) == {
        ("a_2", "rename", "price", "cost"), ("a_2", "type_change", "price", ""), ("a_4", "rename", "price", "cost"),
        ("a_6", "missing_field", "price", ""), ("a_6", "new_field", "cost", ""),
    }


def test_other_content_is_no_rename(spark):
    files = [("a", 1, [rec(1), rec(2)]), ("a", 2, [moved(2, "price", "prices", lambda v: v + 1), moved(1, "price", "prices")])]
    assert changes(spark, files) == {("a_2", "missing_field", "price", ""), ("a_2", "new_field", "prices", "")}


def test_no_repeated_record_no_rename(spark):
    assert changes(spark, [("a", 1, [rec(1)]), ("a", 2, [moved(2, "price", "cost")]), ("b", 3, [moved(1, "price", "cost")])]) == {
        ("a_2", "missing_field", "price", ""), ("a_2", "new_field", "cost", ""), ("b_3", "missing_field", "price", ""), ("b_3", "new_field", "cost", ""),
    }


def test_chain_of_names_wrappers_and_swapped_case(spark):
    files = [
        ("a", 1, [rec(1), rec(2)]),
        ("a", 2, [moved(2, "name", "NAME"), moved(3, "name", "NAME")]),
        ("a", 3, [moved(3, "name", "label", lambda v: [v]), moved(4, "name", "label", lambda v: [v])]),
        ("a", 4, [moved(5, "name", "label", lambda v: {"val": v})]),
    ]
    assert changes(spark, files) == {
        ("a_2", "rename", "name", "NAME"), ("a_3", "rename", "name", "label"), ("a_3", "type_change", "name", ""),
        ("a_4", "rename", "name", "label"), ("a_4", "type_change", "name", ""),
    }


def test_types(spark):
    files = [
        ("a", 1, [rec(1, price=3, flag=None, name=""), rec(2, price=None)]),
        ("a", 2, [rec(1, flag="1"), rec(2, flag="0")]),
        ("a", 3, [rec(1, flag="1"), rec(2, flag=0)]),
        ("a", 4, ['{"id": 1, "price": 1e2, "name": null, "flag": 1.0}']),
        ("a", 5, [rec(1, flag=True, name=["x"])]),
    ]
    assert changes(spark, files) == {("a_2", "type_change", "flag", ""), ("a_4", "type_change", "flag", ""), ("a_5", "type_change", "flag", ""), ("a_5", "type_change", "name", "")}


def test_records_without_fields(spark):
    files = [("a", 1, [None, "", "[1]", "{bad"]), ("a", 2, [rec(1, long="y" * 100_000), rec(1, long="y")])]
    assert changes(spark, files) == {*(("a_1", "missing_field", f, "") for f in ("id", "price", "name", "flag")), ("a_2", "new_field", "long", "")}


def test_empty(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [("a", 1, [rec(1)])], [("other", "x", "string", True)]) == set()


def test_one_table_of_all_files(spark):
    files = [
        ("a", 1, [rec(1), rec(2)]),
        ("a", 2, [moved(2, "price", "cost", str), moved(3, "price", "cost", str)]),
        ("a", 3, [rec(4, price={"val": 7.25, "src": "x"}, name=["n4"], flag=2.5)]),
    ]
    d = drift(spark, files)
    assert {r.field_name: r.union_type for r in d.union_schema().collect()} == {"id": "integer", "price": "number", "name": "string", "flag": "number"}
    assert [tuple(r) for r in d.table("t").orderBy("rec_id").select("id", "price", "name", "flag").collect()] == [
        (1, 1.5, "n1", 1.0), (2, 2.5, "n2", 0.0), (2, 2.5, "n2", 0.0), (3, 3.5, "n3", 1.0), (4, 7.25, "n4", 2.5),
    ]


@pytest.mark.parametrize(
    ("value", "kind"), [("12", "integer"), ("-3", "integer"), ("1.50", "number"), ("012", "string"), ("x", "string"), (True, "boolean"), (None, "null"), ("", "null"), ({"val": 3}, "integer"), ([1, 2], "string"), (2**70, "number"), ("nan", "string")]
)
def test_content_types(value, kind):
    assert fd.content_type(value) == kind


def test_content_is_equal_across_types():
    assert fd.content(57.9) == fd.content("57.90") == fd.content([57.9]) == fd.content({"val": "57.9"})
    assert fd.content(0) == fd.content("0") == fd.content(-0.0) and fd.content("x") != fd.content("y") and fd.content("") is None
