from __future__ import annotations

import pytest

from stratalake.functions import add_result_flags, full_name, stamp_write_times, title_case
from tests.conftest import rows


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("ARGENTINE-ITALIAN", "Argentine-italian"),
        ("o'brien", "O'brien"),
        ("new  zealand", "New  Zealand"),
        ("x\ty", "X\ty"),
        ("élan ÉCOLE", "Élan École"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case_starts_words_at_spaces_only(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert title_case(df, ["v"]).first().v == expected


def test_full_name_skips_missing_parts(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
           (1, named_struct('g', 'LEWIS', 'f', 'hamilton')), (2, named_struct('g', null, 'f', 'senna')),
           (3, named_struct('g', null, 'f', null)), (4, null)
           AS t(id, name)"""
    ).selectExpr("id", "cast(name as struct<g: string, f: string>) AS name")
    named = df.select("id", full_name("name.g", "name.f").alias("n"))
    assert rows(named) == [(1, "Lewis Hamilton"), (2, "Senna"), (3, ""), (4, "")]


def test_flags_are_null_where_the_input_is(spark):
    df = spark.createDataFrame(
        [(1, 25.0), (3, 0.0), (4, None), (None, 12.5)], "final_position int, points double"
    )
    flags = add_result_flags(df).select("is_win", "is_podium", "has_points")
    assert [tuple(r) for r in flags.collect()] == [
        (True, True, True),
        (False, True, False),
        (False, False, None),
        (None, None, True),
    ]


def test_write_times_are_equal(spark):
    row = stamp_write_times(spark.range(1)).first()
    assert row.created_timestamp == row.updated_timestamp
