import ast
import gzip
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revlens.schemas import PRODUCT_LANDING, REVIEW_LANDING
from revlens.sinks.tables import read_table, rejected_records
from revlens.sources import (
    BadRecordBudgetExceeded,
    bad_record_report,
    clean_file,
    clean_records,
    decompress,
    enforce_budget,
    is_strict_json,
    load_landing,
    load_table,
    normalize_lines,
    parse_ndjson,
    read_lines,
    rejected_lines,
)
from revlens.sources import landing
from revlens.sources.lines import read_positioned



def lines_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def write_gzip(path, content):
    with gzip.open(path, "wb") as f:
        f.write(content)
    return str(path)


def test_normalize_lines(spark):
    kept = ['{"a":1}', '{"a":1},', '{"a":1},,', "\t{'a': 1} ,　", " x "]
    dropped = ["", "   ", "[", "]", ",", " [ ", "\t]"]
    got = [r.value for r in normalize_lines(lines_of(spark, kept + dropped)).collect()]
    assert got == ['{"a":1}', '{"a":1}', '{"a":1},', "{'a': 1} ", "x"]


def python_record(line):
    """What a line means, by Python's own parsers; None for a bad line."""
    try:
        return json.loads(line)
    except ValueError:
        try:
            value = ast.literal_eval(line)
            return json.loads(json.dumps(value))
        except (ValueError, SyntaxError, TypeError):
            return None


SHAPES = [
    '{"a": 1}', '{"a":"é"}', '{"a":"\\u00e9"}', "{'a': 'x', 'b': [['p', 'q']]}", '{\'a\': "it\'s"}',
    "{'a': 'it\\'s'}", "{'a': None, 'b': True}", "{u'a': u'x'}", "{'a': '\\x41'}", "{'a': 1.0}",
    "{'a': 1.5, 'b': -2, 'c': 12345678901234567890}", "{'a': 'true'}",
    '{"a":1,"a":2}', "{'a':1,'a':2}", '{"a": "tab\there"}', "{'a': 1,}", "'a' 'b'", "7", '"s"',
    "[1, 2]", "(1, 2)", "{1: 2}", "{'a': 1e5}", "{'a': .5}", "{'a': 1_000}",
    "{'a': [1.0, 2]}", "{'a': -3.0}", "{'a':  0.1234567890123456789}", "{'a': 'so, true'}", "NaN",
    "{'a': 1.0e3}", "{'a': 2.50}", "{'a': [False]}", "{'a':'1.0', 'b': 'null'}", "{ 'a' : 1 }",
    "{'a': {'b': {'c': []}}}", "{'a': '[', 'b': '}'}", "{'a': 'x'},{'a': 'y'}",
    '{"a":1},{"a":2}', "{'a': '~revlens'}", "'''x'''", "{'a': '''x'''}", "r'x'", "{'a': +1}",
]
BAD = [
    "junk", "{'a': true}", "{'a': 007}", '{"a":1} xyz', '{"a":1}{"a":2}', "{'a':1} xyz", "{'a':1}]", '{"a":1}]', "{'a': 1",
    '"x', "{1, 2}", "b'x'", "{'a': x}", "]", "1] , [2", "{'a' 1}", "{[]: 1}", "1 + x", "{'a': 'x'}'",
]


@pytest.mark.parametrize("native", [True, False])
def test_every_record_shape(spark, native):
    df = clean_records(lines_of(spark, SHAPES + BAD), native_literals=native)
    got = {r.value: r.record for r in df.collect()}
    for line in SHAPES:
        assert got[line] is not None, line
        assert repr(json.loads(got[line])) == repr(python_record(line)), line
    for line in BAD:
        assert got[line] is None, line


def test_routes(spark):
    lines = ['{"a":1}', "{'a': 'x'}", "{'a': None}", "junk", '{"a":"\\u00e9"}']
    got = [r.route for r in clean_records(lines_of(spark, lines)).collect()]
    assert got == ["strict", "literal", "repaired", "bad", "repaired"]


def test_non_ascii_stays_raw_and_nulls_stay(spark):
    lines = ['{"a":"\\u00e9"}', "{'a': 'é\\xe9'}", "{'a': None}"]
    got = [r.record for r in clean_records(lines_of(spark, lines)).collect()]
    assert got == ['{"a": "é"}', '{"a": "éé"}', '{"a": null}']


def test_nan_is_a_record_but_not_loadable(spark):
    records = clean_records(lines_of(spark, ['{"asin":"1","price":NaN}'])).select(
        F.col("record").alias("value")
    )
    assert records.first().value == '{"asin": "1", "price": NaN}'
    flagged = parse_ndjson(records, PRODUCT_LANDING)
    assert [r["_bad"] for r in flagged.collect()] == [True]


@pytest.mark.parametrize("line", ["{'asin':'1'}", '{"asin":"1","price":NaN}', '{asin:"1"}', "nope"])
def test_only_json_is_a_good_record(spark, line):
    good = '{"asin":"1","price":"2.5"}'
    flagged = parse_ndjson(lines_of(spark, [line, good]), PRODUCT_LANDING)
    assert sorted(r["_bad"] for r in flagged.collect()) == [False, True]


def test_bad_utf8_fails_review_loads(spark, tmp_path):
    source = write_gzip(tmp_path / "r.gz", b'{"asin":"1","reviewText":"a \xff\xfe b"}\n')
    for schema in (REVIEW_LANDING, None):
        table_dir = str(tmp_path / f"t{schema is None}")
        with pytest.raises(PySparkException):
            load_table(spark, source, table_dir, schema)
        with pytest.raises(FileNotFoundError):
            read_table(spark, table_dir)


values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False)
    | st.text(st.characters(codec="utf-8", exclude_characters="\n\r"), max_size=8),
    lambda inner: st.lists(inner, max_size=3)
    | st.dictionaries(st.text(st.characters(codec="utf-8"), max_size=4), inner, max_size=3),
    max_leaves=6,
)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dictionaries(st.text("abc", min_size=1), values), min_size=1, max_size=30))
def test_python_and_json_text_of_any_record_survive(spark, records):
    texts = [repr(r) for r in records] + [json.dumps(r) for r in records]
    texts = [t for t in texts if t == t.strip() and "\n" not in t]
    got = {r.value: r.record for r in clean_records(lines_of(spark, texts)).collect()}
    for text in texts:
        assert json.loads(got[text]) == python_record(text)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text('{}[]":,1a \\', max_size=14), min_size=1, max_size=200))
def test_strict_json_never_accepts_what_python_rejects(spark, texts):
    df = lines_of(spark, texts).select("value", is_strict_json(F.col("value")).alias("ok"))
    for row in df.collect():
        if row.ok:
            json.loads(row.value)


def test_decompress_keeps_every_line(spark, tmp_path):
    source = write_gzip(tmp_path / "in.gz", "a\n\n  b \nü\r\nlast".encode())
    result = decompress(spark, source, str(tmp_path / "out"))
    assert result["lines_processed"] == 5 and result["status"] == "success"
    got = [r.value for r in read_lines(spark, str(tmp_path / "out")).collect()]
    assert got == ["a", "", "  b ", "ü", "last"]


def test_bad_utf8_fails_the_job(spark, tmp_path):
    source = write_gzip(tmp_path / "in.gz", b"ok\n\xff\xfe\n")
    with pytest.raises(PySparkException, match="INVALID_UTF8"):
        decompress(spark, source, str(tmp_path / "out"))


def test_clean_file(spark, tmp_path):
    content = "[\n{'asin': '1'},\n{\"asin\": \"2\"},\n" + "".join(f"bad {i}\n" for i in range(40))
    source = write_gzip(tmp_path / "in.gz", content.encode())
    result = clean_file(spark, source, str(tmp_path / "out"), partitions=3)
    assert (result["valid_records"], result["parse_errors"]) == (2, 40)
    assert result["bad_lines"] == [f"bad {i}" for i in range(10)]
    kept = rejected_lines(spark, str(tmp_path / "out")).orderBy("row").collect()
    assert [r["line"] for r in kept] == [f"bad {i}" for i in range(40)]
    assert result["input_bytes"] == os.path.getsize(source)
    got = sorted(json.loads(r.value)["asin"] for r in read_lines(spark, result["output_path"]).collect())
    assert got == ["1", "2"]


def test_ten_bad_lines_of_plain_files_are_quoted_in_file_order(spark, tmp_path, conf):
    """Each once, wherever the splits of the file lie."""
    conf(spark__sql__files__maxPartitionBytes="300", spark__sql__files__openCostInBytes="1")
    lines = [f"bad {i}" if i % 20 == 3 else json.dumps({"asin": "x" * (i % 7)}) for i in range(200)]
    (tmp_path / "in.txt").write_text("\n".join(lines))
    result = clean_file(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    assert result["bad_lines"] == [line for line in lines if line.startswith("bad")] and result["parse_errors"] == 10


def test_records_are_written_in_one_form(spark, tmp_path):
    given = ['{"b":9.90,"a" : {"z":1e22,"y":[1.50, -0.0]},"ü":"\\u00e9"}', "{'b': 9.90, 'a': (1, None), u'c': True}", "{}"]
    (tmp_path / "in.txt").write_text("\n".join(given))
    result = clean_file(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    got = {r.value for r in read_lines(spark, result["output_path"]).collect()}
    assert got == {
        '{"b": 9.9, "a": {"z": 1e+22, "y": [1.5, -0.0]}, "ü": "é"}', '{"b": 9.9, "a": [1, null], "c": true}', "{}",
    }


def test_a_load_keeps_rejected_records_with_reasons(spark, tmp_path):
    lines = [
        '{"asin":"1","overall":4}', '{"asin":"2","overall":"4.5"}', '{"asin":"3","overall":"2d"}', "oops",
        '{"overall":1}', '{"asin":"5","unixReviewTime":"7f"}', '{"asin":"6","overall":"+1"}', '{"asin":"7","overall":NaN}',
    ]
    (tmp_path / "in.txt").write_text("\n".join(lines))
    schema = StructType([StructField("asin", StringType(), False), *[REVIEW_LANDING[c] for c in ("overall", "unixReviewTime")]])
    table = str(tmp_path / "t")
    result = load_table(spark, str(tmp_path / "in.txt"), table, schema)
    assert (result["rows_loaded"], result["bad_records"], result["input_bytes"]) == (2, 6, len("\n".join(lines)))
    assert result["reasons"] == {
        "not_one_object": 2, "type:overall": 2, "type:unixReviewTime": 1, "missing:asin": 1,
    }
    assert sorted(map(tuple, read_table(spark, table).collect())) == [("1", 4.0, None), ("2", 4.5, None)]
    rejected = rejected_records(spark, table).orderBy("row").collect()
    assert [r["line"] for r in rejected] == lines[2:]
    assert rejected[0]["reason"] == "type:overall" and rejected[0]["file"].endswith("in.txt")
    with pytest.raises(BadRecordBudgetExceeded, match="missing:asin"):
        load_table(spark, str(tmp_path / "in.txt"), table, schema, max_bad=5)
    assert read_table(spark, table).count() == 2


def test_a_load_of_nothing_is_an_empty_table(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\n")
    load_table(spark, str(tmp_path / "in.txt"), str(tmp_path / "t"), REVIEW_LANDING)
    assert read_table(spark, str(tmp_path / "t")).columns == REVIEW_LANDING.fieldNames()
    assert read_table(spark, str(tmp_path / "t")).count() == 0


def test_inference_reads_a_gzip_once(spark, tmp_path, monkeypatch):
    lines = ['{"b":1,"a":"x","n":null,"l":[1,2],"o":{"k":1.5}}', '{"b":2.5,"m":true,"l":[3.5],"e":{}}', "bad", "[1]", '{"m":"yes"}']
    source = write_gzip(tmp_path / "in.gz", "\n".join(lines).encode())
    reads = []
    monkeypatch.setattr(landing, "read_positioned", lambda *a: reads.append(a) or read_positioned(*a))
    monkeypatch.setattr(landing, "read_lines", lambda *a: reads.append(a))
    load_table(spark, source, str(tmp_path / "t"))
    assert len(reads) == 1
    got = read_table(spark, str(tmp_path / "t"))
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {
        "a": "string", "b": "double", "e": "string", "l": "array<double>", "m": "string", "n": "string",
        "o": "struct<k:double>",
    }
    assert got.count() == 3 and [r.b for r in got.where("a = 'x'").collect()] == [1.0]


def test_clean_file_without_bad_lines(spark, tmp_path):
    source = write_gzip(tmp_path / "in.gz", b'{"a":1}\n')
    result = clean_file(spark, source, str(tmp_path / "out"), sample_limit=0)
    assert (result["valid_records"], result["parse_errors"], result["bad_lines"]) == (1, 0, [])


def test_bad_record_report(spark):
    report = bad_record_report(clean_records(lines_of(spark, ["{}", "x", "{'a': 1}"])))
    assert report.first().asDict() == {"valid_records": 2, "parse_errors": 1}


def test_parse_ndjson_flags(spark):
    good = ['{"asin":"1","price":3.5,"other":[1],"categories":[["A", "B"]]}', '{"asin":"2","title":null}']
    bad = ['{"title":"x"}', '[{"asin":"3"}]', "5", '"x"', '{"asin":"4"} x', '{"asin":"5"', "null",
           '{"asin":"6"}{"asin":"7"}', '{"asin":null}']
    rows = parse_ndjson(lines_of(spark, [*good, *bad, "", "  "]), PRODUCT_LANDING).collect()
    assert [r._bad for r in rows] == [False] * 2 + [True] * len(bad)
    assert (rows[0].asin, rows[0].price, rows[0].categories) == ("1", "3.5", '[["A","B"]]')


def test_typed_fields(spark):
    lines = [
        '{"reviewerID":"r","helpful":[1, 2],"overall":5.0,"unixReviewTime":1370000000}',
        '{"reviewerID":"r","helpful":[],"overall":4}',
        '{"reviewerID":"r","overall":"great"}',
        '{"reviewerID":"r","unixReviewTime":{"a":1}}',
        '{"reviewerID":"r","helpful":3}',
        '{"reviewerID":"r","helpful":["a"]}',
        '{"reviewerID":"r","unixReviewTime":5.5}',
        '{"reviewerID":"r","overall":"5","unixReviewTime":"7","helpful":[1]}',
        '{"reviewerID":"r"},{"overall":1}',
        '{"reviewerID":"r","overall":1},"x":{"y":2}',
        '{"reviewerID":"r"}]} x',
        '{"reviewerID":7,"overall":null}',
    ]
    rows = parse_ndjson(lines_of(spark, lines), REVIEW_LANDING).collect()
    assert [r._bad for r in rows] == [False] * 2 + [True] * 5 + [False] + [True] * 3 + [False]
    assert (rows[7].overall, rows[7].unixReviewTime, rows[7].helpful) == (5.0, 7, [1])
    assert rows[11].reviewerID == "7"
    assert (rows[0].helpful, rows[0].overall, rows[0].unixReviewTime) == ([1, 2], 5.0, 1370000000)
    assert (rows[1].helpful, rows[1].overall) == ([], 4.0)


@pytest.mark.parametrize(("bad", "passes"), [(10, True), (11, False)])
def test_bad_record_budget(spark, tmp_path, bad, passes):
    path, table = str(tmp_path / "in"), str(tmp_path / "table")
    lines_of(spark, ['{"asin":"1"}'] * 5 + ["{}"] * bad).write.text(path)
    if passes:
        assert load_landing(spark, path, PRODUCT_LANDING).count() == 5
        result = load_table(spark, path, table, PRODUCT_LANDING)
        assert (result["rows_loaded"], result["bad_records"]) == (5, 10)
        assert read_table(spark, table).count() == 5
    else:
        with pytest.raises(BadRecordBudgetExceeded):
            load_landing(spark, path, PRODUCT_LANDING)
        with pytest.raises(BadRecordBudgetExceeded):
            load_table(spark, path, table, PRODUCT_LANDING)
        with pytest.raises(FileNotFoundError):
            read_table(spark, table)


def test_a_failed_load_leaves_the_old_table(spark, tmp_path):
    table = str(tmp_path / "table")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    lines_of(spark, ['{"asin":"1"}']).write.text(good)
    lines_of(spark, ["x"] * 11).write.text(bad)
    load_table(spark, good, table, PRODUCT_LANDING)
    with pytest.raises(BadRecordBudgetExceeded):
        load_table(spark, bad, table, PRODUCT_LANDING)
    assert read_table(spark, table).count() == 1
    load_table(spark, good, table, PRODUCT_LANDING)
    assert read_table(spark, table).count() == 1


def test_a_line_with_the_end_marker_is_bad_not_lost(spark):
    from revlens.sources.records import END_MARKER

    lines = [f'{{"asin":"1"}},{{"{END_MARKER}":1}}]}} x', f'{{"asin":"{END_MARKER}"}}']
    for schema in (PRODUCT_LANDING, REVIEW_LANDING):
        assert [r._bad for r in parse_ndjson(lines_of(spark, lines), schema).collect()] == [True, True]
    records = clean_records(lines_of(spark, lines[1:] + [f'{{"a":1}},"{END_MARKER}"] x']))
    assert [r.route for r in records.collect()] == ["repaired", "bad"]


def test_field_names_with_dots(spark):
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("a.b", LongType(), nullable=False)])
    rows = parse_ndjson(lines_of(spark, ['{"a.b":1}', '{"a":{"b":1}}']), schema).collect()
    assert [tuple(r) for r in rows] == [(1, False), (None, True)]


def test_empty_file(spark, tmp_path):
    path = str(tmp_path / "in")
    lines_of(spark, [""]).write.text(path)
    assert load_landing(spark, path, PRODUCT_LANDING).count() == 0


def test_inferred_schema(spark, tmp_path):
    path = str(tmp_path / "in")
    lines_of(spark, ['{"b":1,"a":"x","h":[1,2]}', "oops", '{"b":2}']).write.text(path)
    df = load_landing(spark, path)
    assert dict(df.dtypes) == {"a": "string", "b": "bigint", "h": "array<bigint>"}
    assert df.count() == 2
    assert enforce_budget(parse_ndjson(read_lines(spark, path), df.schema), 1).count() == 2


def test_each_line_is_parsed_and_repaired_once(spark):
    """A filter on the route, or on bad records, must not repeat the steps behind it."""
    kept = clean_records(lines_of(spark, ["{'asin': '1', 'title': None}", '{"asin":"1"}'])).where(F.col("route") != "strict")
    flagged = parse_ndjson(kept.select(F.col("record").alias("value")), PRODUCT_LANDING).where("NOT _bad")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("repair_records(") == 1
    assert plan.count("VariantExpressionEvalUtils.parseJson(") == 1
    assert plan.count("from_json(") == 2
    assert flagged.count() == 1
