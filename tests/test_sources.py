from __future__ import annotations

import os

import pytest

from stratalake.functions import add_ingestion_metadata
from stratalake.sources import batch_path, in_time_order, landing_batches, read_csv, read_json, valid_batch_id
from tests.conftest import rows

SCHEMA = "a STRING, b INT, d DATE"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_reads_typed_rows(spark, tmp_path):
    path = put(tmp_path / "ok.csv", "a,b,d\nx,1,2024-02-29\ny,,\n")
    df = read_csv(spark, path, SCHEMA)
    assert df.dtypes == [("a", "string"), ("b", "int"), ("d", "date")]
    assert [(r.a, r.b, str(r.d)) for r in df.orderBy("a").collect()] == [
        ("x", 1, "2024-02-29"), ("y", None, "None"),
    ]


@pytest.mark.parametrize(
    "text",
    ["a,b,d\nx,one,2024-01-01\n", "a,b,d\nx,1\n", "a,b,d\nx,1,2024-01-01,9\n", "a,b,d\nx,1,not-a-date\n"],
    ids=["bad cell", "short row", "long row", "bad date"],
)
def test_csv_malformed_rows_fail(spark, tmp_path, text):
    df = read_csv(spark, put(tmp_path / "bad.csv", text), SCHEMA)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|FAILFAST"):
        df.collect()


def test_csv_bad_cell_is_only_seen_when_its_column_is_read(spark, tmp_path):
    df = read_csv(spark, put(tmp_path / "bad.csv", "a,b,d\nx,one,2024-01-01\n"), SCHEMA)
    assert rows(df, "a") == [("x",)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        rows(df, "b")


def test_csv_swapped_header_fails_unless_allowed(spark, tmp_path):
    path = put(tmp_path / "swapped.csv", "b,a\nx,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, "a STRING, b STRING").collect()
    assert rows(read_csv(spark, path, "a STRING, b STRING", check_header=False)) == [("x", "y")]


def test_json_lines(spark, tmp_path):
    text = '{"a": 5, "b": 1, "d": "2024-01-01", "extra": true}\n{"a": "y"}\n'
    df = read_json(spark, put(tmp_path / "ok.json", text), SCHEMA)
    assert [(r.a, r.b) for r in df.orderBy("a").collect()] == [("5", 1), ("y", None)]


@pytest.mark.parametrize(
    "line",
    ['{"b": "12"}', '{"b": 1.5}', '{"d": "not-a-date"}', '{"a": "x"'],
    ids=["text for int", "fraction for int", "bad date", "cut off"],
)
def test_json_malformed_rows_fail(spark, tmp_path, line):
    df = read_json(spark, put(tmp_path / "bad.json", line + "\n"), SCHEMA)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        df.collect()


def test_json_nested_struct_stays_nested(spark, tmp_path):
    text = '{"n": {"g": "A", "f": "B"}}\n{"n": {"f": "C"}}\n{}\n'
    df = read_json(spark, put(tmp_path / "n.json", text), "n STRUCT<g: STRING, f: STRING>")
    assert sorted((r.n and (r.n.g, r.n.f) for r in df.collect()), key=repr) == [("A", "B"), (None, "C"), None]


def test_json_folder_is_one_relation(spark, tmp_path):
    put(tmp_path / "r" / "1.json", '{"b": 1}\n')
    put(tmp_path / "r" / "2.json", '{"b": 2}\n{"b": 3}\n')
    df = add_ingestion_metadata(read_json(spark, str(tmp_path / "r"), SCHEMA))
    assert [(r.b, os.path.basename(r.source_file)) for r in df.orderBy("b").collect()] == [
        (1, "1.json"), (2, "2.json"), (3, "2.json"),
    ]
    assert df.select("ingestion_timestamp").distinct().count() == 1


def test_multi_line_documents_hold_arrays_or_objects(spark, tmp_path):
    put(tmp_path / "m" / "1.json", '[\n{"b": 1},\n{"b":\n 2}\n]')
    put(tmp_path / "m" / "2.json", '{\n"b":\n3\n}')
    path = str(tmp_path / "m")
    assert rows(read_json(spark, path, "b INT", multi_line=True)) == [(1,), (2,), (3,)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_json(spark, path, "b INT").collect()


def test_batch_ids():
    assert valid_batch_id("2025-01") == "2025-01"
    assert batch_path("/data/landing/", "2025-01", "circuits.csv") == "/data/landing/2025-01/circuits.csv"
    for missing in ("", None):
        with pytest.raises(ValueError, match="missing"):
            valid_batch_id(missing)
    for wrong in ("../x", "a/b", "a'b", ".hidden"):
        with pytest.raises(ValueError, match="not a batch id"):
            valid_batch_id(wrong)


def test_landing_batches_are_the_folders_that_fit_the_pattern(spark, tmp_path):
    landing = tmp_path / "landing"
    assert landing_batches(spark, str(landing)) == []
    for name in ("2025-02", "2025-01", "archive", "old", "_tmp", ".staging", "7 of it"):
        (landing / name).mkdir(parents=True)
    put(landing / "2025-03", "not a folder")
    assert sorted(landing_batches(spark, str(landing))) == ["2025-01", "2025-02"]
    assert sorted(landing_batches(spark, str(landing), "old|arch.*")) == ["archive", "old"]


def test_ids_of_one_length_have_an_order_in_time():
    assert in_time_order(["2025-02", "2025-01"]) == ["2025-01", "2025-02"] and in_time_order([]) == []
    with pytest.raises(ValueError, match="differ in length.*2025-003"):
        in_time_order(["2025-01", "2025-003", "2025-02"])
