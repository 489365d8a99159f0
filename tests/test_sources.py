import json
import random

import pytest
from pyspark.sql import functions as F

from lakeq.sources import generator, lake_table, registry, rest, scans
from tests.conftest import rows

TRADE = "1|2014-01-01 10:00:00|CMPT|TMB|0|ABC|10|1.5|7|3|15.0|1|2|3"


def test_typed_scan(spark, tmp_path):
    lines = [TRADE, TRADE.replace("|10|", "|ten|"), TRADE + "|x", "a|b", "", "   ", TRADE.replace("|1.5|", "||")]
    (tmp_path / "Trade.txt").write_text("\n".join(lines) + "\n")
    df = scans.typed_columns(scans.delimited_lines(spark, str(tmp_path)), "trade").collect()
    assert [r._parse_errors for r in df] == [[], ["trade_quantity: cannot convert 'ten' to integer"], ["field_count_mismatch"], ["field_count_mismatch"], []]
    assert df[0].trade_price == 1.5 and df[4].trade_price is None and (df[2]._expected_fields, df[2]._actual_fields) == (14, 15) and df[3]._raw == "a|b"
    assert scans.count_records(spark, str(tmp_path)).first().n == 5 and scans.count_records(spark, str(tmp_path), header=True).first().n == 4


def test_required_and_booleans(spark):
    day = "|".join(["", "2024-1-5", "d", *["1"] * 14, "yes"])
    r = scans.typed_columns(spark.createDataFrame([(day,)], "line string"), "date").first()
    assert r._parse_errors == ["sk_date is required"] and str(r.date_value) == "2024-01-05" and r.holiday_flag is True


def test_line_numbers_over_splits(spark, tmp_path):
    text = [f"line {i} " + "x" * random.Random(i).randint(0, 50) for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(text))
    (tmp_path / "b.txt").write_text("only")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = scans.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.record_number: r.line for r in df if r.source_file.endswith("a.txt")} == {i + 1: t for i, t in enumerate(text)} and len(df) == 5001


def test_quoted_records(spark, tmp_path):
    (tmp_path / "HR.csv").write_text('1,"a\nb",c\n2,d,e\n')
    assert [(r.record_number, r.line) for r in scans.quoted_records(spark, str(tmp_path), ",").orderBy("record_number").collect()] == [(1, '1,"a\nb",c'), (2, "2,d,e")]


def test_wire_records(spark):
    body = "".join(str(w % 10) * 0 + f"{n[:w]:<{w}}" for n, w in scans.WIRE["SEC"])
    lines = spark.createDataFrame([("20140101-101112SEC" + body,), ("20140101-101112",), ("  ",)], "line string")
    records = scans.wire_records(lines)
    assert sorted(r.record_type for r in records.collect()) == ["", "SEC"]
    r = scans.wire_fields(records, "SEC").first()
    assert r.symbol == "symbol" and r.co_name_or_cik == "co_name_or_cik" and r.posting_ts == "20140101-101112"


XML = """<?xml version="1.0"?><TPCDI:Actions xmlns:TPCDI="http://www.tpc.org/tpc-di">
<TPCDI:Action ActionType="NEW" ActionTS="2014-01-01T00:00:00"><Customer C_ID="1" C_TAX_ID="9" C_GNDR="F" C_TIER="2" C_DOB="1980-01-01"><Name><C_L_NAME>L</C_L_NAME><C_F_NAME>F</C_F_NAME></Name>
<Account CA_ID="5" CA_TAX_ST="1"><CA_B_ID>7</CA_B_ID><CA_NAME>n</CA_NAME></Account><Account CA_ID="6" CA_TAX_ST="0"/></Customer></TPCDI:Action>
<TPCDI:Action ActionType="INACT" ActionTS="2014-02-01T00:00:00"><Customer C_ID="2"/></TPCDI:Action></TPCDI:Actions>"""


def test_customer_actions(spark, tmp_path):
    (tmp_path / "CustomerMgmt.xml").write_text(XML)
    customers, accounts = scans.customer_actions(spark, str(tmp_path / "CustomerMgmt.xml"))
    assert rows(customers.select("action_type", "c_id", "C_L_NAME")) == [("INACT", "2", None), ("NEW", "1", "L")]
    assert rows(accounts.select("action_type", "c_id", "ca_id", "ca_b_id")) == [("NEW", "1", "5", "7"), ("NEW", "1", "6", None)]


def test_artifacts(spark, tmp_path):
    records = [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]
    (tmp_path / "x.json").write_text(json.dumps({"meta": 1, "data": {"items": records}}))
    (tmp_path / "x.jsonl").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "x.csv").write_text("Id,The Name\n1,a\n2,b\n")
    assert [json.loads(r.record) for r in scans.read_artifact(spark, str(tmp_path / "x.json")).collect()] == records
    assert rows(scans.read_artifact(spark, str(tmp_path / "x.jsonl")).select("id", "name")) == [(1, "a"), (2, "b")]
    assert scans.read_artifact(spark, str(tmp_path / "x.csv")).columns == ["id", "the_name"]
    with pytest.raises(ValueError):
        scans.read_artifact(spark, "x.doc")
    (tmp_path / "report.txt").write_text("AUDIT\nTotal Records: 1,234\nx\n")
    assert rows(scans.report_totals(spark, str(tmp_path / "report.txt"))) == [("Total Records", 1234)]


def test_registry():
    assert len(registry.SOURCES) == 17 and len(registry.SOURCES["trade"].columns) == 14 and len(registry.SOURCES["customer_update"].columns) == 33
    assert "batch_date" not in registry.sources_of_batch(1) and "batch_date" in registry.sources_of_batch(1, True) and "hr" not in registry.sources_of_batch(2)
    assert registry.resolve_files(["b/Trade.txt", "a/Trade.txt", "a/Trade_audit.csv", "x"], "trade") == ["a/Trade.txt", "b/Trade.txt"]


def test_upserts(spark, tmp_path):
    table = lake_table.LakeTable(spark, str(tmp_path / "t"))
    schema = "k string, j int, v int"
    base = spark.createDataFrame([("a", 1, 1), (None, 1, 1), ("b", None, 1)], schema)
    delta = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), (None, 1, 2), ("c", 1, 1)], schema)
    assert table.merge(base, ["k", "j", "zz"], ["v"]) == ["k", "j"]
    table.merge(delta, ["k", "j"], ["v"])
    once = rows(table.read())
    table.merge(delta, ["k", "j"], ["v"])
    assert rows(table.read()) == once == sorted([("a", 1, 3), (None, 1, 2), ("b", None, 1), ("c", 1, 1)], key=repr) and table.version() == 3
    table.merge(spark.createDataFrame([("d", 1, 1, "new")], schema + ", extra string"), ["k", "j"], ["v"])
    assert table.read().columns == ["k", "j", "v", "extra"] and table.read().count() == 5
    table.merge(spark.createDataFrame([("d", 1, 1)], schema), ["nothing"])
    assert table.read().count() == 6
    table.replace(base)
    assert table.read().count() == 3


def test_commits_survive_a_stop_between_any_two_steps(spark, tmp_path, monkeypatch):
    table = lake_table.LakeTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(100))
    table.replace(spark.range(1000))
    stop = RuntimeError("stopped")

    def stopped(*_):
        raise stop

    for name in ("write_data", "commit"):
        with monkeypatch.context() as patch:
            patch.setattr(lake_table.LakeTable, name, stopped)
            for act in (lambda: table.merge(spark.range(5), ["id"]), lambda: table.append(spark.range(5)), lambda: table.replace(spark.range(5))):
                with pytest.raises(RuntimeError):
                    act()
        assert lake_table.LakeTable(spark, table.path).read().count() == 1000
    (tmp_path / "t" / "_commits" / ".left").write_text("[")  # a commit that never got its number
    assert table.version() == 2 and table.read().count() == 1000 and table.read(1).count() == 100


def test_of_two_writers_one_fails(spark, tmp_path):
    a, b = (lake_table.LakeTable(spark, str(tmp_path / "t")) for _ in range(2))
    a.replace(spark.range(10))
    before, name = b.version(), b.write_data(spark.range(3), [])
    a.append(spark.range(10, 12))
    with pytest.raises(lake_table.ConflictError):
        b.commit([name], before)
    assert b.read().count() == 12


def test_append_writes_new_files_only(spark, tmp_path):
    table = lake_table.LakeTable(spark, str(tmp_path / "t"))
    table.append(spark.range(10))
    first = table.folders()
    table.append(spark.range(5).withColumn("extra", F.lit("x")))
    assert table.folders()[:1] == first and table.read().count() == 15 and table.read().columns == ["id", "extra"]
    table.compact()
    assert table.vacuum(keep=1) == 2 and table.read().count() == 15 and len(table.folders()) == 1


def test_identifiers():
    assert lake_table.merge_condition(["window_start", "location_id"]) == "target.window_start <=> source.window_start AND target.location_id <=> source.location_id"
    with pytest.raises(ValueError):
        lake_table.merge_condition(["a; drop"])


def test_sinks(spark, tmp_path):
    df = spark.range(50).withColumn("s", F.col("id").cast("string"))
    lake_table.write_partitioned(df, str(tmp_path / "p"), "id", 4)
    assert spark.read.json(str(tmp_path / "p")).select("part").distinct().count() == 4
    for fmt in ("csv", "json", "parquet", "orc"):
        lake_table.export(df, str(tmp_path / fmt), fmt)
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        assert reader.format(fmt).load(str(tmp_path / fmt)).count() == 50
    with pytest.raises(ValueError):
        lake_table.export(df, "x", "doc")


def test_generator(spark):
    columns = {"sk_id": "integer", "trade_price": "number", "trade_date": "string", "is_cash": "boolean", "name": "string"}
    clean = generator.generate(spark, columns, 500)
    assert rows(clean) == rows(generator.generate(spark, columns, 500)) and clean.select("sk_id").distinct().count() == 500
    dirty = generator.generate(spark, columns, 4000, preset="high")
    assert 4100 < dirty.count() < 4300 and 350 < dirty.filter("name IS NULL").count() < 500 and dirty.filter("trade_price = 'NOT_A_NUMBER'").count() > 100


def test_pages_and_retries():
    answers = {"u1": [(500, {}, ""), (429, {"Retry-After": "7"}, ""), (200, {}, json.dumps({"data": [1, 2], "links": {"next": "u2"}}))], "u2": [(200, {}, json.dumps({"items": [3], "next_page_url": "u3"}))], "u3": [(404, {}, "")]}
    waits = []
    fetch = lambda url, headers: answers[url].pop(0)
    body = rest.with_retries(fetch, "u1", {}, sleep=waits.append)
    assert waits == [1.0, 7.0] and json.loads(body)["data"] == [1, 2]
    answers["u1"] = [(200, {}, body)]
    assert list(rest.pages("u1", {}, fetch, max_pages=2)) == [[1, 2], [3]]
    with pytest.raises(OSError):
        rest.with_retries(fetch, "u3", {})
    assert rest.auth_headers("bearer", "x") == {"Authorization": "Bearer x"} and rest.auth_headers("header", "A=b") == {"A": "b"}
