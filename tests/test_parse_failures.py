import csv
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeq.operators import parse_failures as pf
from tests.conftest import rows

KINDS = ("integer", "string", "decimal", "date", "timestamp")


def naive(line, delimiter):
    """The stated grammar, character by character: fields, or None where quoting is broken."""
    fields, at = [], 0
    while True:
        if line[at : at + 1] == '"':
            at, value = at + 1, ""
            while True:
                if at >= len(line):
                    return None
                if line[at] == '"':
                    if line[at + 1 : at + 2] == '"':
                        value, at = value + '"', at + 2
                        continue
                    at += 1
                    break
                value, at = value + line[at], at + 1
            if at < len(line) and line[at] != delimiter:
                return None
        else:
            end = line.find(delimiter, at)
            end = len(line) if end < 0 else end
            value, at = line[at:end], end
        fields.append(value)
        if at >= len(line):
            return fields
        at += 1


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='a"| \n\r1', max_size=14))
def test_split_against_the_grammar(line):
    body = line[:-1] if line.endswith("\n") else line
    body = body[:-1] if body.endswith("\r") else body
    try:
        mine = pf.split_record(line, "|")
    except csv.Error:
        mine = "broken"
    if not body.replace("|", "").strip():
        assert mine is None
    else:
        expected = naive(body, "|")
        assert mine == ("broken" if expected is None else expected)


def judged(*values):
    return pf.judge("|".join(values), "|", KINDS)[1]


def test_values():
    good = ("1", "x", "1.5", "2024-02-29", "2024-01-01 23:59:59")
    assert judged(*good) is None
    assert judged(" -9223372036854775808 ", "", ".5", "", "") is None
    assert judged("+5", "", "-5.", "", "") is None
    for at, bad in [(0, "9223372036854775808"), (0, "1.0"), (0, "1_0"), (0, "٣"), (2, "."), (2, "1e5"), (2, "1.2.3"), (2, "nan"), (3, "2023-02-29"), (3, "2024-1-5"), (3, "0000-01-01"), (4, "2024-01-01 24:00:00"), (4, "2024-01-01T00:00:00"), (1, "a�")]:
        values = list(good)
        values[at] = bad
        assert judged(*values) == "invalid_value", bad


def test_reasons_come_in_order():
    assert pf.judge('1|"x', "|", KINDS)[1] == "broken_quoting"
    assert pf.judge("bad|x", "|", KINDS)[1] == "field_count_mismatch"
    assert pf.judge(None, "|", KINDS) == (None, None, None)
    assert pf.judge(" | ||", "|", KINDS) == (None, None, None)
    assert pf.judge("\r", "|", KINDS) == (None, None, None)


def assembled(lines, width=None):
    return [r for _, r in pf.assemble_records("\n".join(lines), "|", width)]


def test_assembly_joins_lines_of_open_quotes():
    assert assembled(['1|"a', 'b"|2', "3|c", '4|d"e', "", '5|"x""', '"|y\r']) == ['1|"a\nb"|2', "3|c", '4|d"e', "", '5|"x""\n"|y\r']
    assert list(pf.assemble_records('1|"a\nb"|2\n3|c\n', "|")) == [(1, '1|"a\nb"|2'), (3, "3|c")]


def test_an_open_quote_costs_one_line():
    lines = ['1|"open', "2|ok", "3|ok", "4|ok"]
    assert assembled(lines) == lines
    assert assembled(['1|"open', '2|"ok"|', '3|"a', 'b"']) == ['1|"open', '2|"ok"|', '3|"a\nb"']
    assert assembled(['1|"open', '2|ok"|z', "3|ok"], width=2) == ['1|"open', '2|ok"|z', "3|ok"]  # joined, it would have three fields
    assert assembled(['1|"a', 'b"|2', "3|c"], width=3) == ['1|"a\nb"|2', "3|c"]


def test_assembly_is_linear():
    began = time.perf_counter()
    text = "\n".join(['1|"open|""|' + "x" * 40] * 40_000)
    assert sum(1 for _ in pf.assemble_records(text, "|", 3)) == 40_000
    assert time.perf_counter() - began < 10


def test_assembled_files(spark):
    lines = ['1|"a', 'b"|2024-01-01', '2|"open|2024-01-01', "3|c|2024-01-01", "", "x|d|2024-01-01"]
    given = spark.createDataFrame([("f1", "t", "|", n, x) for n, x in enumerate(lines)], "source_file string, source_name string, delimiter string, n long, line string")
    records = pf.assembled(given, layout(spark), ["n"])
    judged = pf.parse_lines(records, layout(spark), "record_number")
    assert rows(pf.failures(judged, "record_number")) == [(3, "broken_quoting"), (6, "invalid_value")]
    assert rows(pf.typed_records(judged, layout(spark), "t", "record_number").select("record_number", "name")) == [(1, "a\nb"), (4, "c")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab"|\n ', max_size=6), min_size=2, max_size=3), min_size=1, max_size=4))
def test_written_records_are_read_back(records):
    text = "\n".join("|".join('"' + f.replace('"', '""') + '"' for f in r) for r in records)
    back = [pf.split_record(r, "|") for _, r in pf.assemble_records(text, "|")]
    assert back == records


LINES = "line_id long, source_name string, delimiter string, raw_line string, batchid long, reason string"
LAYOUT = "source_name string, col_no long, column_name string, value_type string, reason string"


def layout(spark):
    return spark.createDataFrame([("t", 2, "name", "string", ""), ("t", 1, "id", "integer", ""), ("t", 3, "day", "date", "")], LAYOUT)


def test_operator_edges(spark):
    long = "x" * 300_000
    given = [
        (1, "t", "|", "1|a|2024-01-01", 1, "clash"), (2, "t", "|", "x|a|2024-01-01", 1, None), (2, "t", "|", "x|a|2024-01-01", 1, None), (3, "t", "|", None, 1, None),
        (4, "none", "|", "1|2", None, None), (5, None, None, "1", None, None), (6, "t", "~", f"7~{long}~", 1, None), (7, "t", "||", "8||b||2024-01-01", 1, None),
        (None, "t", "|", '1|"a|', 1, None), (8, "t", "|", "", 1, None), (9, "t", "|", '9|"p|q\nr"|2024-05-05\r', 1, None),
    ]
    judged = pf.parse_lines(spark.createDataFrame(given, LINES), layout(spark))
    assert rows(pf.failures(judged)) == sorted([(2, "invalid_value"), (2, "invalid_value"), (4, "field_count_mismatch"), (5, "field_count_mismatch"), (None, "broken_quoting")], key=repr)
    typed = {r[0]: r for r in pf.typed_records(judged, layout(spark), "t").collect()}
    assert set(typed) == {1, 6, 7, 9} and typed[6].name == long and typed[6].day is None and typed[9].name == "p|q\nr"


def test_empty(spark):
    empty = spark.createDataFrame([], LINES)
    assert pf.failures(pf.parse_lines(empty, layout(spark))).count() == 0
    assert pf.failures(pf.parse_lines(empty, spark.createDataFrame([], LAYOUT))).count() == 0


def test_every_line_of_the_data_is_judged_once(spark, data):
    from lakeq.plans import problems

    layouts = pf.layouts_of(spark.read.parquet(f"{data}/source_layouts.parquet"))
    expected = set()
    for r in spark.read.parquet(f"{data}/raw_lines.parquet").collect():
        line = r.raw_line.removesuffix("\r")
        if not line.replace(r.delimiter, "").strip():
            continue
        fields, kinds = naive(line, r.delimiter), [k for _, k in layouts[r.source_name]]
        if fields is None:
            expected.add((r.line_id, "broken_quoting"))
        elif len(fields) != len(kinds):
            expected.add((r.line_id, "field_count_mismatch"))
        elif any(bad(f, k) for f, k in zip(fields, kinds)):
            expected.add((r.line_id, "invalid_value"))
    assert set(rows(problems.p1_found(spark, data))) == expected and expected


def bad(text, kind):
    from datetime import datetime

    if kind == "string":
        return "�" in text
    text = text.strip()
    if not text:
        return False
    try:
        if kind == "integer":
            return not (text.isascii() and text.lstrip("+-").isdigit() and -(2**63) <= int(text) < 2**63)
        if kind == "decimal":
            return not (text.replace("+", "0", 1).replace("-", "0", 1).replace(".", "", 1).isdigit() and any(c.isdigit() for c in text) and not any(c in "+-" for c in text[1:]))
        datetime.strptime(text, "%Y-%m-%d" if kind == "date" else "%Y-%m-%d %H:%M:%S")
        return len(text) != (10 if kind == "date" else 19)
    except ValueError:
        return True
