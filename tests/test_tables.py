from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.functions import stamp_write_times
from stratalake.operators.merge import merge_rows
from stratalake.sinks import (
    TableLayout,
    append,
    create_view,
    delete_all,
    ensure_table,
    insert_values,
    overwrite,
    prune_versions,
    replace_partition,
    upsert,
)
from stratalake.sinks import tables
from tests.conftest import rows

KV = "k int, v string, batch_id string"
GUARD = "s.batch_id >= t.batch_id"


def frame(spark, data, schema=KV):
    return spark.createDataFrame(data, schema)


def test_overwrite_append_delete(spark, lake):
    name = lake.name("silver", "t")
    overwrite(frame(spark, [(1, "a", "b1")]), name)
    append(frame(spark, [(2, "b", "b1")]).select("batch_id", "v", "k"), name)
    assert rows(spark.table(name)) == [(1, "a", "b1"), (2, "b", "b1")]
    overwrite(spark.table(name).where("k = 2"), name)
    assert rows(spark.table(name)) == [(2, "b", "b1")]
    delete_all(spark, name)
    assert rows(spark.table(name)) == []
    append(frame(spark, [(3, "c", "b1")]), name)
    assert rows(spark.table(name)) == [(3, "c", "b1")]


def test_writes_refuse_other_columns(spark, lake):
    name = lake.name("silver", "t")
    overwrite(frame(spark, [(1, "a", "b1")]), name)
    for other in ("k long, v string, batch_id string", "k int, w string, batch_id string"):
        with pytest.raises(ValueError, match="columns differ"):
            overwrite(frame(spark, [(1, "a", "b1")], other), name)


def test_overwrite_of_a_partitioned_table_drops_missing_partitions(spark, lake):
    name = lake.name("gold", "t")
    layout = TableLayout(partition_by="k")
    overwrite(frame(spark, [(1, "a", "x"), (2, "b", "x"), (None, "n", "x")]), name, layout)
    assert rows(spark.table(name), "k", "v") == [(1, "a"), (2, "b"), (None, "n")]
    overwrite(frame(spark, [(2, "c", "x"), (3, "d", "x")]), name)
    assert rows(spark.table(name), "k", "v") == [(2, "c"), (3, "d")]


def test_create_insert_view(spark, lake):
    name, view = lake.name("control", "e"), lake.name("control", "v_e")
    for _ in range(2):
        ensure_table(spark, name, "batch_id INT, event_timestamp TIMESTAMP")
    insert_values(spark, name, "(1, current_timestamp())", "(2, current_timestamp())")
    create_view(spark, view, f"SELECT batch_id + 1 AS n FROM {name}")
    create_view(spark, view, f"SELECT batch_id + 2 AS n FROM {name}")
    assert rows(spark.table(view)) == [(3,), (4,)]


def test_replace_partition_leaves_the_others(spark, lake):
    name = lake.name("bronze", "t")
    for batch, data in (("2025-01", [(1, "a")]), ("2025-02", [(1, "b"), (2, "c")])):
        replace_partition(frame(spark, data, "k int, v string"), name, "batch_id", batch)
    replace_partition(frame(spark, [(9, "z")], "k int, v string"), name, "batch_id", "2025-01")
    assert rows(spark.table(name)) == [(1, "b", "2025-02"), (2, "c", "2025-02"), (9, "z", "2025-01")]
    replace_partition(frame(spark, [], "k int, v string"), name, "batch_id", "2025-02")
    assert rows(spark.table(name)) == [(9, "z", "2025-01")]
    scan = spark.table(name).where("batch_id = '2025-01'")
    assert all("2025-02" not in f for f in scan.inputFiles()) and len(scan.inputFiles()) >= 1
    with pytest.raises(ValueError, match="partition value"):
        replace_partition(frame(spark, [], "k int, v string"), name, "batch_id", "a/b")


def test_replace_partition_keeps_text_ids_as_text(spark, lake):
    name = lake.name("bronze", "t")
    for batch in ("20250101", "2025-01-01"):
        replace_partition(frame(spark, [(1, "a")], "k int, v string"), name, "batch_id", batch)
    assert dict(spark.table(name).dtypes)["batch_id"] == "string"
    assert rows(spark.table(name), "batch_id") == [("2025-01-01",), ("20250101",)]


def test_failed_write_changes_nothing(spark, lake):
    name = lake.name("bronze", "t")
    replace_partition(frame(spark, [(1, "a")], "k int, v string"), name, "batch_id", "b1")
    broken = frame(spark, [(1, "a")], "k int, v string").withColumn("v", F.expr("raise_error('broken')").cast("string"))
    with pytest.raises(Exception, match="broken"):
        replace_partition(broken, name, "batch_id", "b1")
    assert rows(spark.table(name)) == [(1, "a", "b1")]


LAYOUTS = {
    "plain, small source": (TableLayout(), True),
    "plain, large source": (TableLayout(), False),
    "bucketed": (TableLayout(bucket_by=("k",), buckets=3), None),
    "partitioned, small source": (TableLayout(partition_by="k"), True),
    "partitioned, size counted": (TableLayout(partition_by="k"), None),
}


@pytest.fixture(params=LAYOUTS, ids=list(LAYOUTS))
def layout_and_size(request):
    return LAYOUTS[request.param]


def run_upserts(spark, name, batches, layout_and_size, guard=GUARD):
    layout, small = layout_and_size
    for data in batches:
        upsert(
            frame(spark, data), name, keys=["k"], update=["v", "batch_id"], guard=guard,
            layout=layout, small_source=small,
        )
    return rows(spark.table(name), "k", "v", "batch_id")


START = [(1, "old", "2"), (2, "keep", "2"), (3, "null batch", None), (None, "null key", "2")]
CHANGE = [(1, "newer", "3"), (4, "new", "3"), (None, "another", "3")]


def test_newer_batch_updates_and_inserts(spark, lake, layout_and_size):
    got = run_upserts(spark, lake.name("silver", "t"), [START, CHANGE], layout_and_size)
    assert got == sorted(
        [(1, "newer", "3"), (2, "keep", "2"), (3, "null batch", None), (4, "new", "3"),
         (None, "null key", "2"), (None, "another", "3")],
        key=repr,
    )


@pytest.mark.parametrize(
    ("source", "guarded", "unguarded"),
    [
        ((1, "same", "2"), "same", "same"),
        ((1, "older", "1"), "old", "older"),
        ((1, "no batch", None), "old", "no batch"),
        ((3, "target without batch", "9"), "null batch", "target without batch"),
    ],
)
def test_guard_cases(spark, lake, source, guarded, unguarded):
    for guard, expected in ((GUARD, guarded), (None, unguarded)):
        name = lake.name("silver", "g" if guard else "u")
        got = run_upserts(spark, name, [START, [source]], LAYOUTS["plain, small source"], guard)
        assert [v for k, v, _ in got if k == source[0]] == [expected]


def test_null_key_is_inserted_on_every_run(spark, lake, layout_and_size):
    got = run_upserts(spark, lake.name("silver", "t"), [START, CHANGE, CHANGE], layout_and_size)
    assert [v for k, v, _ in got if k is None] == ["another", "another", "null key"]
    assert len(got) == 7


def test_two_source_rows_for_one_target_row_are_an_error(spark, lake, layout_and_size):
    name = lake.name("silver", "t")
    twice = [(1, "x", "3"), (1, "y", "3")]
    with pytest.raises(ValueError, match="several source rows"):
        run_upserts(spark, name, [START, twice], layout_and_size)
    assert rows(spark.table(name), "k", "v", "batch_id") == sorted(START, key=repr)
    new_twice = [(8, "x", "3"), (8, "y", "3"), (None, "n", "3"), (None, "n", "3")]
    got = run_upserts(spark, name, [new_twice], layout_and_size)
    assert len(got) == len(START) + 4


def test_update_only_with_match_filter(spark, lake):
    name = lake.name("control", "t")
    overwrite(frame(spark, [("b1", "in_progress"), ("b1", "completed"), ("b1", "in_progress"), ("b2", "in_progress")], "batch_id string, status string"), name)
    done = frame(spark, [("b1", "completed"), ("b9", "completed")], "batch_id string, status string")
    upsert(done, name, keys=["batch_id"], update=["status"], match="t.status = 'in_progress'", insert=False)
    assert rows(spark.table(name)) == [("b1", "completed")] * 3 + [("b2", "in_progress")]
    with pytest.raises(ValueError, match="no table"):
        upsert(done, lake.name("control", "none"), keys=["batch_id"], update=[], insert=False)


def test_created_time_stays_and_updated_time_moves(spark, lake):
    name = lake.name("silver", "t")
    for value in ("a", "b"):
        upsert(
            stamp_write_times(frame(spark, [(1, value, "b")])), name, keys=["k"],
            update=["v", "updated_timestamp"],
        )
    row = spark.table(name).first()
    assert row.v == "b" and row.created_timestamp < row.updated_timestamp


def test_partitioned_upsert_rewrites_only_reached_partitions(spark, lake):
    name = lake.name("gold", "t")
    layout = TableLayout(partition_by="k")
    overwrite(frame(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", "x")]), name, layout)
    before = set(spark.table(name).inputFiles())
    upsert(frame(spark, [(2, "B", "y"), (7, "G", "y")]), name, keys=["k"], update=["v"])
    after = set(spark.table(name).inputFiles())
    assert rows(spark.table(name), "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (7, "G")]
    assert {f.split("/k=")[1][0] for f in before & after} == {"1", "3"}
    with pytest.raises(ValueError, match="not a merge key"):
        upsert(frame(spark, [(2, "B", "y")]), name, keys=["v"], update=["batch_id"])


def test_bytes_of_the_staged_source_decide_the_join(spark, lake, monkeypatch):
    name, chosen = lake.name("silver", "t"), []

    def recording(*args, small_source, **options):
        chosen.append(small_source)
        return merge_rows(*args, small_source=small_source, **options)

    monkeypatch.setattr(tables, "merge_rows", recording)
    overwrite(spark.range(40).selectExpr("cast(id AS int) AS k", "'a' AS v", "'1' AS batch_id"), name)
    change = frame(spark, [(k, "b", "2") for k in range(5)])
    for limit in ("10m", "100b", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            upsert(change, name, keys=["k"], update=["v"])
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert chosen == [True, False, False]
    assert spark.table(name).where("v = 'b'").count() == 5


def test_unique_source_skips_staging(spark, lake):
    name = lake.name("silver", "t")
    for _ in range(2):
        upsert(
            frame(spark, [(1, "a", "1")]), name, keys=["k"], update=["v"], unique_source=True,
            small_source=False,
        )
    assert rows(spark.table(name), "k", "v") == [(1, "a")]


def test_append_after_partition_moves(spark, lake):
    """Appended rows join the current version of a partition, and new partitions work."""
    name = lake.name("gold", "t")
    overwrite(frame(spark, [(1, "a", "x"), (2, "b", "x")]), name, TableLayout(partition_by="k"))
    upsert(frame(spark, [(2, "B", "x")]), name, keys=["k"], update=["v"])
    append(frame(spark, [(2, "more", "x"), (3, "new", "x")]), name)
    assert rows(spark.table(name), "k", "v") == [(1, "a"), (2, "B"), (2, "more"), (3, "new")]
    upsert(frame(spark, [(3, "NEW", "x")]), name, keys=["k"], update=["v"])
    assert rows(spark.table(name), "k", "v") == [(1, "a"), (2, "B"), (2, "more"), (3, "NEW")]
    delete_all(spark, name)
    assert rows(spark.table(name)) == []


def test_upsert_reaching_many_partitions_writes_few_files(spark, lake):
    name = lake.name("gold", "t")
    ids = spark.range(600).selectExpr("cast(id % 6 AS int) AS k", "cast(id AS string) AS v", "'1' AS batch_id")
    overwrite(ids, name, TableLayout(partition_by="k"))
    upsert(
        ids.withColumn("batch_id", F.lit("2")), name, keys=["k", "v"], update=["batch_id"],
        unique_source=True,
    )
    table = spark.table(name)
    assert table.where("batch_id = '2'").count() == 600
    assert len(table.inputFiles()) == 6


def test_merge_needs_its_columns(spark):
    df = frame(spark, [(1, "a", "b")])
    with pytest.raises(ValueError, match="lacks columns"):
        merge_rows(df, df.drop("v"), keys=["k"], update=["v"])


def test_bucketed_merge_does_not_shuffle_the_target(spark, lake):
    name = lake.name("silver", "t")
    ids = spark.range(1000).selectExpr("cast(id AS int) AS k", "'a' AS v", "'b' AS batch_id")
    overwrite(ids, name, TableLayout(bucket_by=("k",), buckets=4))
    merged = merge_rows(spark.table(name), ids, keys=["k"], update=["v"], buckets=(4, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1, plan


def test_partitioned_bucketed_upsert_reads_the_target_in_place(spark, lake, monkeypatch):
    name, plans = lake.name("gold", "t"), []
    write = tables._write_version

    def recording(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    layout = TableLayout(partition_by="batch_id", bucket_by=("k",), buckets=4)
    overwrite(spark.range(400).selectExpr("cast(id AS int) AS k", "'a' AS v", "cast(id % 3 AS string) AS batch_id"), name, layout)
    monkeypatch.setattr(tables, "_write_version", recording)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        change = frame(spark, [(0, "b", "0"), (1, "c", "0")])
        upsert(change, name, keys=["k", "batch_id"], update=["v"], unique_source=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange") == 1, plans[0]
    assert spark.table(name).count() == 401
    assert rows(spark.table(name).where("v <> 'a'"), "k", "v") == [(0, "b"), (1, "c")]


def test_prune_removes_only_dead_versions(spark, lake):
    for layout, name in (
        (TableLayout(), lake.name("silver", "plain")),
        (TableLayout(partition_by="k"), lake.name("silver", "parted")),
    ):
        overwrite(frame(spark, [(1, "a", "x"), (2, "b", "x")]), name, layout)
        upsert(frame(spark, [(2, "B", "x")]), name, keys=["k"], update=["v"])
        upsert(frame(spark, [(2, "BB", "x")]), name, keys=["k"], update=["v"])
        assert prune_versions(spark, name) == []
        dead = prune_versions(spark, name, older_than_hours=0)
        assert len(dead) == (2 if layout == TableLayout() else 1)
        assert rows(spark.table(name), "k", "v") == [(1, "a"), (2, "BB")]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(order=st.permutations(["1", "2", "3"]), keys=st.lists(st.sets(st.integers(0, 4)), min_size=3, max_size=3))
def test_order_of_batches_does_not_matter(spark, order, keys):
    """With the guard, the newest batch holding a key decides its row."""
    batches = {b: [(k, f"{k}@{b}", b) for k in sorted(ks)] for b, ks in zip("123", keys)}
    target = frame(spark, batches[order[0]])
    for batch_id in order[1:]:
        target = merge_rows(
            target, frame(spark, batches[batch_id]), keys=["k"], update=["v", "batch_id"],
            guard=GUARD, small_source=batch_id != "2",
        )
    newest = {k: b for b in "123" for k, _, _ in batches[b]}
    assert rows(target) == [(k, f"{k}@{b}", b) for k, b in sorted(newest.items())]


def test_layout_is_read_back(spark, lake):
    name = lake.name("gold", "t")
    layout = TableLayout(partition_by="batch_id", bucket_by=("k", "v"), buckets=3)
    overwrite(frame(spark, [(1, "a", "x")]), name, layout)
    assert tables._stored_layout(spark, name) == layout


@pytest.mark.parametrize("match", [None, "s.v = 'x'", "t.v <> s.v"])
def test_both_merge_plans_give_the_same_rows(spark, match):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    source = spark.createDataFrame(
        [(1, "x"), (2, "b"), (3, "x"), (3, "q"), (None, "c"), (None, "x")]
        + ([(1, "q")] if match == "s.v = 'x'" else []),
        "k int, v string",
    )
    plans = [
        merge_rows(target, source, keys=["k"], update=["v"], match=match, small_source=small)
        for small in (True, False)
    ]
    assert rows(plans[0]) == rows(plans[1])


def test_repeated_source_keys_are_judged_by_the_match(spark, lake):
    name = lake.name("silver", "judged")
    overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    source = spark.createDataFrame([(1, "x"), (1, "q"), (2, "y"), (2, "z")], "k int, v string")
    upsert(source, name, keys=["k"], update=["v"], match="s.v = 'x'")
    assert rows(spark.table(name)) == [(1, "q"), (1, "x"), (2, "y"), (2, "z")]
    with pytest.raises(ValueError, match="several source rows"):
        upsert(spark.createDataFrame([(2, "m"), (2, "n")], "k int, v string"), name, keys=["k"], update=["v"], match="s.v <> t.v")


def test_equal_target_rows_are_judged_one_by_one(spark, lake):
    """Each of two equal target rows meets one source row: no error, also with columns that cannot
    be compared or grouped."""
    schema = "k int, v string, m map<string, int>"
    source = frame(spark, [(1, "p", {"a": 1}), (1, "q", {"b": 2}), (3, "p", None), (3, "p", None)], schema)
    for small in (True, False, None):
        name = lake.name("silver", f"t_{small}")
        overwrite(frame(spark, [(1, "x", None), (1, "x", None), (None, "n", None)], schema), name)
        upsert(source, name, keys=["k"], update=["v", "m"], match="s.v = 'p'", small_source=small)
        got = [(r.k, r.v, r.m) for r in spark.table(name).collect()]
        assert sorted(got, key=repr) == sorted(
            [(1, "p", {"a": 1})] * 2 + [(1, "q", {"b": 2}), (None, "n", None)] + [(3, "p", None)] * 2, key=repr
        )
        both = frame(spark, [(1, "s", None), (1, "t", None)], schema)
        with pytest.raises(ValueError, match='several source rows.*"k":1'):
            upsert(both, name, keys=["k"], update=["v"], match="s.v <> t.v", small_source=small)
        assert spark.table(name).count() == 6


@pytest.mark.parametrize("small", [True, False, None])
def test_a_wrong_unique_source_is_found_out(spark, lake, small):
    name = lake.name("silver", "t")
    overwrite(frame(spark, START), name)
    for twice in ([(1, "x", "3"), (1, "y", "3")], [(9, "x", "3"), (9, "y", "3")]):
        with pytest.raises(ValueError, match="repeats a key"):
            upsert(frame(spark, twice), name, keys=["k"], update=["v"], unique_source=True, small_source=small)
    assert rows(spark.table(name), "k", "v", "batch_id") == sorted(START, key=repr)
    nulls = [(None, "x", "3"), (None, "y", "3"), (1, "z", "3")]
    upsert(frame(spark, nulls), name, keys=["k"], update=["v"], unique_source=True, small_source=small)
    assert spark.table(name).count() == len(START) + 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_cannot_match_leave_the_join(spark, lake, no_broadcasts):
    """A third of the keys are null on both sides: a bucketed target is read in place all the same."""
    name = lake.name("silver", "t")
    key = F.when(F.col("id") % 3 != 0, F.col("id")).cast("int")
    old = spark.range(900).select(key.alias("k"), F.lit("old").alias("v"), F.lit("1").alias("batch_id"))
    new = spark.range(300, 1500).select(key.alias("k"), F.lit("new").alias("v"), F.lit("2").alias("batch_id"))
    overwrite(old, name, TableLayout(bucket_by=("k",), buckets=4))
    merged = merge_rows(spark.table(name), new, keys=["k"], update=["v"], buckets=(4, ["k"]))
    assert plan_of(merged).count("Exchange") == 1, plan_of(merged)
    upsert(new, name, keys=["k"], update=["v", "batch_id"])
    table = spark.table(name)
    assert table.where("k is null").groupBy("v").count().orderBy("v").collect() == [("new", 400), ("old", 300)]
    assert table.where("k is not null").groupBy("v").count().orderBy("v").collect() == [("new", 800), ("old", 200)]


def test_an_unbroadcast_source_costs_two_exchanges(spark, lake, no_broadcasts):
    name, source = lake.name("silver", "t"), lake.name("silver", "s")
    ids = spark.range(100).selectExpr("cast(id AS int) AS k", "'a' AS v", "'1' AS batch_id")
    overwrite(ids, name)
    overwrite(ids, source)
    for options in ({}, {"guard": GUARD}, {"unique_source": True}):
        merged = merge_rows(spark.table(name), spark.table(source), keys=["k"], update=["v"], **options)
        assert plan_of(merged).count("Exchange") == 2


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    target=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("ab")), max_size=6),
    source=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from("abc")), max_size=4, unique_by=lambda r: r[0]),
    insert=st.booleans(), match=st.sampled_from([None, "t.v <> s.v", "s.v = 'a'"]),
)
def test_both_plans_follow_the_merge_rules(spark, target, source, insert, match):
    def fits(t, s):
        return t[0] is not None and t[0] == s[0] and (match is None or (t[1] != s[1] if "t.v" in match else s[1] == "a"))

    want = [next((s for s in source if fits(t, s)), t) for t in target]
    if insert:
        want += [s for s in source if not any(fits(t, s) for t in target)]
    schema = "k int, v string"
    for small in (True, False):
        merged = merge_rows(
            frame(spark, target, schema), frame(spark, source, schema), keys=["k"], update=["v"], match=match,
            insert=insert, small_source=small,
        )
        assert rows(merged) == sorted(want, key=repr)


def test_partitions_of_several_columns(spark, lake, monkeypatch):
    """An upsert rewrites the pairs it reaches, not their seasons, and asks the catalog about no other."""
    name = lake.name("gold", "t")
    schema, layout = "season int, round int, k int, v string", TableLayout(partition_by=("season", "round"))
    overwrite(frame(spark, [(s, r, s * r, "a") for s in (1, 2, 3) for r in (1, 2)] + [(1, None, 0, "n")], schema), name, layout)
    assert tables._stored_layout(spark, name) == layout
    before = set(spark.table(name).inputFiles())
    asked, sql = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: asked.append(text) or sql(self, text, *a, **b))
    change = [(1, 1, 1, "B"), (3, 2, 6, "C"), (3, 2, 7, "new"), (4, 1, 4, "new"), (1, None, 0, "again")]
    upsert(frame(spark, change, schema), name, keys=["season", "round", "k"], update=["v"])
    monkeypatch.undo()
    assert not [text for text in asked if text == f"SHOW PARTITIONS {name}"]
    got = spark.table(name).select("season", "round", "k", "v")
    assert rows(got) == sorted(
        [(1, 1, 1, "B"), (1, 2, 2, "a"), (2, 1, 2, "a"), (2, 2, 4, "a"), (3, 1, 3, "a"), (3, 2, 6, "C"),
         (3, 2, 7, "new"), (4, 1, 4, "new"), (1, None, 0, "n"), (1, None, 0, "again")], key=repr,
    )
    kept = {f.split("season=")[1].split("/part")[0] for f in before & set(spark.table(name).inputFiles())}
    assert kept == {"1/round=2", "2/round=1", "2/round=2", "3/round=1"}
    pruned = got.where("season = 3 AND round = 2").inputFiles()
    assert all("season=3/round=2" in f for f in pruned)
    overwrite(frame(spark, [(3, 2, 6, "only")], schema), name)
    assert rows(spark.table(name), "season", "round", "k", "v") == [(3, 2, 6, "only")]
    with pytest.raises(ValueError, match="partitioned by round, which is not a merge key"):
        upsert(frame(spark, change, schema), name, keys=["season", "k"], update=["v"])
    assert len(prune_versions(spark, name, older_than_hours=0)) == 2
