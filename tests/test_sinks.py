"""Sink behaviour: upsert replaces by key within touched partitions only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costlens.sinks import tables as T


def test_upsert_replaces_and_keeps_other_partitions(spark, tmp_table_root):
    path = tmp_table_root + "/t"
    schema = "k string, v double, period_date date"
    first = spark.createDataFrame([("a", 1.0, dt.date(1997, 1, 31)), ("b", 2.0, dt.date(1997, 1, 31)),
                                   ("a", 9.0, dt.date(1996, 12, 31))], schema)
    assert T.upsert(spark, first, path, ["k", "period_date"], partition_by="period_date")["inserted"] == 3
    second = spark.createDataFrame([("a", 5.0, dt.date(1997, 1, 31)), ("c", 3.0, dt.date(1997, 1, 31))], schema)
    assert T.upsert(spark, second, path, ["k", "period_date"], partition_by="period_date")["inserted"] == 2
    got = sorted((r["k"], r["v"], str(r["period_date"])) for r in T.read_table(spark, path).collect())
    assert got == [("a", 5.0, "1997-01-31"), ("a", 9.0, "1996-12-31"), ("b", 2.0, "1997-01-31"),
                   ("c", 3.0, "1997-01-31")]


def test_upsert_without_partitions_and_schema_evolution(spark, tmp_table_root):
    path = tmp_table_root + "/u"
    T.upsert(spark, spark.createDataFrame([("a", 1.0)], "k string, v double"), path, ["k"])
    T.upsert(spark, spark.createDataFrame([("b", 2.0, "x")], "k string, v double, extra string"), path, ["k"])
    got = sorted((r["k"], r["v"], r["extra"]) for r in T.read_table(spark, path).collect())
    assert got == [("a", 1.0, None), ("b", 2.0, "x")]


def test_upsert_duplicate_keys_raise_and_leave_the_table(spark, tmp_table_root):
    path = tmp_table_root + "/d"
    T.upsert(spark, spark.createDataFrame([("a", 7.0)], "k string, v double"), path, ["k"])
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    with pytest.raises(T.DuplicateKeys):
        T.upsert(spark, df, path, ["k"])
    assert [(r["k"], r["v"]) for r in T.read_table(spark, path).collect()] == [("a", 7.0)]


def test_duplicates_are_sought_by_hash_and_settled_by_key(spark, tmp_table_root):
    """No task holds the batch's keys as texts; keys that only share a hash aren't duplicates."""
    sch = "k string, l string, v double"
    met = spark.createDataFrame([(None, "a", 1.0), ("a", None, 2.0), ("b", "c", 3.0)], sch)
    assert met.select(F.xxhash64("k", "l")).distinct().count() == 2
    grouped = T._hashes_twice(met, ["k", "l"])
    assert "xxhash64(k" in grouped._jdf.queryExecution().executedPlan().toString()
    assert grouped.count() == 1
    T.upsert(spark, met, tmp_table_root + "/h", ["k", "l"])
    assert T.read_table(spark, tmp_table_root + "/h").count() == 3
    for twice in ([("a", None, 1.0), ("a", None, 2.0)], [(None, None, 1.0), (None, None, 1.0), (None, "a", 1.0)]):
        with pytest.raises(T.DuplicateKeys):
            T.upsert(spark, spark.createDataFrame(twice, sch), tmp_table_root + "/h", ["k", "l"])
    assert T.read_table(spark, tmp_table_root + "/h").count() == 3


def test_upsert_moves_keys_between_partitions(spark, tmp_table_root):
    """A partition column outside the key: a row whose month changed leaves its old one."""
    path = tmp_table_root + "/m"
    sch = "k string, v double, mes string"
    T.upsert(spark, spark.createDataFrame([("a", 1.0, "1997-01"), ("b", 2.0, "1997-01"), ("c", 3.0, "1997-02 x/y")], sch),
             path, ["k"], partition_by="mes")
    T.upsert(spark, spark.createDataFrame([("a", 5.0, "1997-03"), ("c", 6.0, "1997-03")], sch), path, ["k"], partition_by="mes")
    got = sorted((r["k"], r["v"], str(r["mes"])) for r in T.read_table(spark, path).collect())
    assert got == [("a", 5.0, "1997-03"), ("b", 2.0, "1997-01"), ("c", 6.0, "1997-03")]


def test_empty_batches(spark, tmp_table_root):
    path = tmp_table_root + "/e"
    rows = spark.createDataFrame([("a", 1.0)], "k string, v double")
    assert T.upsert(spark, rows.limit(0), path, ["k"])["inserted"] == 0
    assert T.upsert(spark, rows, path, ["k"])["inserted"] == 1
    assert T.upsert(spark, rows.limit(0), path, ["k"])["inserted"] == 0
    assert T.read_table(spark, path).count() == 1


def test_latest_rows_tie_break(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", 1, "r1", at), ("a", 2, "r2", at)], "k string, v int, snapshot_run_id string, snapshot_run_ts timestamp")
    assert [r["v"] for r in T.latest_rows(df, ["k"]).collect()] == [2]


def test_append_duplicates_on_rerun(spark, tmp_table_root):
    path = tmp_table_root + "/app"
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    T.append(df, path)
    T.append(df, path)
    assert T.read_table(spark, path).count() == 2


def test_latest_rows_null_timestamp_first(spark):
    df = spark.createDataFrame(
        [("a", 1, dt.datetime(2024, 1, 1)), ("a", 2, dt.datetime(2024, 2, 1)), ("b", 3, None),
         ("b", 4, dt.datetime(2024, 3, 1))], "k string, v int, snapshot_run_ts timestamp")
    got = sorted((r["k"], r["v"]) for r in T.latest_rows(df, ["k"]).collect())
    assert got == [("a", 2), ("b", 3)]


def test_stamp_and_run_log(spark, tmp_table_root):
    st = T.RunStamp.new()
    df = T.stamp_run(spark.createDataFrame([("a",)], "k string"), st)
    assert df.columns == ["snapshot_run_id", "snapshot_run_ts", "k"]
    T.append_run_log(spark, tmp_table_root + "/log", st, {"year": 1997, "month": 1})
    row = spark.read.parquet(tmp_table_root + "/log").first()
    assert row["snapshot_run_id"] == st.run_id and '"month":1' in row["params_json"]


def test_two_level_partitions_keep_text_and_untouched_files(spark, tmp_table_root):
    import os
    from pyspark.sql import types as ST
    path = tmp_table_root + "/p2"
    sch = ST.StructType([ST.StructField("k", ST.StringType()), ST.StructField("v", ST.DoubleType()),
                         ST.StructField("period_date", ST.DateType()), ST.StructField("company_name", ST.StringType())])
    jan = dt.date(1997, 1, 31)
    keys, parts = ["k", "period_date", "company_name"], ["period_date", "company_name"]
    T.upsert(spark, spark.createDataFrame([("a", 1.0, jan, "0001"), ("b", 2.0, jan, "ACME")], sch),
             path, keys, partition_by=parts, schema=sch)
    local = path.replace("file:", "")
    acme = os.path.join(local, "period_date=1997-01-31", "company_name=ACME")
    before = sorted(os.listdir(acme))
    T.upsert(spark, spark.createDataFrame([("a", 5.0, jan, "0001")], sch), path, keys,
             partition_by=parts, schema=sch)
    assert sorted(os.listdir(acme)) == before            # untouched partition not rewritten
    got = sorted((r["k"], r["v"], r["company_name"]) for r in T.read_table(spark, path, sch).collect())
    assert got == [("a", 5.0, "0001"), ("b", 2.0, "ACME")]   # '0001' stays text


def _parts(spark, rows):
    return spark.createDataFrame(rows, "k string, v double, p string")


def _found(spark, path):
    return sorted((r["k"], r["v"], str(r["p"])) for r in T.read_table(spark, path).collect())


class _Crash(Exception):
    pass


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
@pytest.mark.parametrize("half", [False, True])
def test_interrupted_commit_is_finished_by_the_next_write(spark, tmp_table_root, monkeypatch, moves, half):
    """A crash after some moves, or in the middle of one (the old folder set aside, the new one not
    yet in its place): the table is whole again before the next write."""
    from costlens.sinks import commit as J

    path = f"{tmp_table_root}/crash-{moves}-{half}"
    T.upsert(spark, _parts(spark, [(k, 1.0, p) for p in "abcd" for k in ("x", "y")]), path, ["k", "p"], partition_by="p")
    done = []

    def move(spark_, staging, table, rel):
        if len(done) >= moves:
            if half:
                fs, target = J.fs_path(spark_, f"{table}/{rel}")
                hadoop = spark_.sparkContext._jvm.org.apache.hadoop.fs.Path
                old = hadoop(f"{staging}/old/{rel}")
                fs.mkdirs(old.getParent())
                assert fs.rename(target, old)
            raise _Crash(rel)
        done.append(rel)
        J.replace_folder(spark_, staging, table, rel)

    real = J.commit
    monkeypatch.setattr(J, "MOVERS", 1)
    monkeypatch.setattr(J, "commit", lambda *a, **k: real(*a, **k, move=move))
    with pytest.raises(_Crash):
        T.upsert(spark, _parts(spark, [("x", 2.0, p) for p in "abcd"]), path, ["k", "p"], partition_by="p")
    monkeypatch.setattr(J, "commit", real)
    assert J.pending(spark, path) is not None
    want = sorted([("x", 2.0, p) for p in "abcd"] + [("y", 1.0, p) for p in "abcd"])
    T.upsert(spark, _parts(spark, [("z", 3.0, "e")]), path, ["k", "p"], partition_by="p")
    assert _found(spark, path) == sorted([*want, ("z", 3.0, "e")])
    assert J.pending(spark, path) is None and not T.recover(spark, path)


def test_crash_before_the_commit_point_leaves_the_table(spark, tmp_table_root, monkeypatch):
    from costlens.sinks import commit as J

    path = f"{tmp_table_root}/early"
    T.upsert(spark, _parts(spark, [("x", 1.0, "a")]), path, ["k", "p"], partition_by="p")
    real = J.commit
    monkeypatch.setattr(J, "commit", lambda *a, **k: (_ for _ in ()).throw(_Crash()))
    with pytest.raises(_Crash):
        T.upsert(spark, _parts(spark, [("x", 2.0, "a")]), path, ["k", "p"], partition_by="p")
    monkeypatch.setattr(J, "commit", real)
    assert J.pending(spark, path) is None and _found(spark, path) == [("x", 1.0, "a")]


def test_second_writer_stops_at_a_journal(spark, tmp_table_root):
    from costlens.sinks import commit as J

    path = f"{tmp_table_root}/two"
    T.upsert(spark, _parts(spark, [("x", 1.0, "a")]), path, ["k", "p"], partition_by="p")
    staging = J.staging_for(path)
    _parts(spark, [("x", 5.0, "a")]).write.partitionBy("p").parquet(f"{staging}/new")
    assert J.write_text(spark, J._journal(path), '{"staging": "%s", "depth": 1, "columns": null}' % staging, replace=False)
    with pytest.raises(J.CommitInProgress):
        J.commit(spark, staging, path, 1)
    assert T.recover(spark, path) and _found(spark, path) == [("x", 5.0, "a")]


def test_partitions_that_only_lost_rows_go(spark, tmp_table_root):
    path = f"{tmp_table_root}/lost"
    T.upsert(spark, _parts(spark, [("x", 1.0, "a b/c"), ("y", 1.0, "d"), ("z", 1.0, None)]), path, ["k"], partition_by="p")
    T.upsert(spark, _parts(spark, [("x", 2.0, "d"), ("z", 2.0, "d")]), path, ["k"], partition_by="p")
    assert _found(spark, path) == [("x", 2.0, "d"), ("y", 1.0, "d"), ("z", 2.0, "d")]


def test_columns_of_other_runs_and_tools_survive(spark, tmp_table_root):
    """Columns beyond the declared ones: brought by a batch, or by files that another tool wrote."""
    path = f"{tmp_table_root}/wide"
    declared = spark.createDataFrame([], "k string, v double, p string").schema
    rows = "k string, v double, p string, note string"
    T.upsert(spark, spark.createDataFrame([("x", 1.0, "a", "n1"), ("y", 1.0, "a", "n2"), ("w", 1.0, "b", "n3")], rows), path, ["k", "p"],
             partition_by="p", schema=declared)
    spark.createDataFrame([("q", 1.0, 7)], "k string, v double, other long").write.mode("append").parquet(f"{path}/p=a")
    T.upsert(spark, _parts(spark, [("x", 2.0, "a")]), path, ["k", "p"], partition_by="p", schema=declared)
    got = {r["k"]: r.asDict() for r in T.read_table(spark, path, declared).collect()}
    assert got["y"] == {"k": "y", "v": 1.0, "p": "a", "note": "n2", "other": None}
    assert got["q"] == {"k": "q", "v": 1.0, "p": "a", "note": None, "other": 7}
    assert got["x"]["v"] == 2.0 and got["x"]["note"] is None and got["w"]["note"] == "n3"
    assert [f.name for f in T.table_schema(spark, path, declared).fields] == ["k", "v", "p", "note", "other"]


def test_refused_requests_go_to_quarantine(spark, tmp_table_root):
    """A null key and a repeated key refuse their requests, whole; all others are written."""
    path = f"{tmp_table_root}/iso"
    sch = "snapshot_run_id string, r string, k string, v double"
    rows = [("run1", "ok", "a", 1.0), ("run1", "ok", "b", 2.0), ("run1", "twice", "a", 1.0), ("run1", "twice", "a", 2.0), ("run1", "twice", "c", 3.0),
            ("run1", "nokey", None, 1.0), ("run1", "nokey", "d", 1.0), ("run1", None, "a", 1.0)]
    out = T.upsert(spark, spark.createDataFrame(rows, sch), path, ["r", "k"], isolate=["r"])
    assert (out["inserted"], out["rejected"]) == (2, 6)
    assert sorted((r["r"], r["k"]) for r in T.read_table(spark, path).collect()) == [("ok", "a"), ("ok", "b")]
    bad = T.quarantined(spark, path, "run1")
    assert {(r["r"], r["refused_because"]) for r in bad.collect()} == {("twice", T.DUPLICATE_KEY), ("nokey", T.NULL_KEY), (None, T.NULL_KEY)}
    assert T.quarantined(spark, path, "run2").count() == 0 and T.quarantined(spark, f"{path}-none") is None
    again = T.upsert(spark, spark.createDataFrame(rows[2:5], sch), path, ["r", "k"], isolate=["r"])
    assert (again["inserted"], again["rejected"]) == (0, 3) and T.read_table(spark, path).count() == 2


def test_keep_first(spark):
    rows = [("a", 2, "x", 1.0), ("a", 1, "z", 2.0), ("a", 1, "y", 3.0), ("b", None, "x", 4.0), ("b", 5, None, 5.0), (None, 1, "x", 6.0), (None, 1, "x", 6.0)]
    df = spark.createDataFrame(rows, "k string, o int, t string, v double")
    got = sorted(map(tuple, T.keep_first(df, ["k"], ["o"]).collect()), key=str)
    assert got == sorted([("a", 1, "y", 3.0), ("b", 5, None, 5.0), (None, 1, "x", 6.0)], key=str)
    assert T.keep_first(df.select("k"), ["k"], []).count() == 3
    assert T.keep_first(df.limit(0), ["k"], ["o"]).count() == 0


def test_latest_rows_without_a_window(spark, tmp_table_root):
    """One aggregation with a partial step before the shuffle; a filter on a partition column prunes."""
    at = dt.datetime(2024, 1, 1)
    rows = [(k, p, float(i), f"r{i}", None if i == 3 and k == "a" else at + dt.timedelta(hours=i % 3)) for i in range(6) for k in "ab" for p in ("1996-12", "1997-01")]
    df = spark.createDataFrame(rows, "k string, p string, v double, snapshot_run_id string, snapshot_run_ts timestamp")
    df.write.partitionBy("p").parquet(f"{tmp_table_root}/latest")
    table = spark.read.schema(df.schema).parquet(f"{tmp_table_root}/latest")
    latest = T.latest_rows(table, ["k", "p"])
    assert {(r["k"], r["p"]): r["v"] for r in latest.collect()} == {("a", p): 3.0 for p in ("1996-12", "1997-01")} | {("b", p): 5.0 for p in ("1996-12", "1997-01")}
    plan = latest.where("p = '1997-01'")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
    assert "PartitionFilters: [isnotnull(p#" in plan and "= 1997-01" in plan


def test_run_log_parameters(spark, tmp_table_root):
    st = T.RunStamp.new()
    T.append_run_log(spark, f"{tmp_table_root}/log2", st, {"b": None, "a": 'x"y', "n": 1.5, "t": True, "d": dt.date(1997, 1, 1)})
    T.append_run_log(spark, f"{tmp_table_root}/log2", st, {})
    import json
    got = [json.loads(r["params_json"]) for r in spark.read.parquet(f"{tmp_table_root}/log2").collect()]
    assert {"a": 'x"y', "b": None, "d": "1997-01-01", "n": 1.5, "t": True} in got and {} in got


def test_latest_rows_and_appends_sort_no_whole_file(spark, tmp_table_root, monkeypatch):
    """Rows are shuffled by key before the first sort of the latest rows, whatever keys hold; appended rows of one
    period are written as they come, and the session's setting is as before."""
    from pyspark.sql.readwriter import DataFrameWriter
    name, seen, old = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(name)), old(self, *a, **k)))
    before, path = spark.conf.get(name), tmp_table_root + "/latest"
    rows = [(k, l, f"r{run}", dt.datetime(2024, 1, 1 + run), 10 * run + i, p)
            for run in range(3) for p in ("x", "y", "z", "u", "v", None)
            for i, (k, l) in enumerate([("a", None), (None, "a"), (None, None), ("b", "c")])]
    df = spark.createDataFrame(rows, "k string, l string, snapshot_run_id string, snapshot_run_ts timestamp, v int, p string")
    assert T.append(df, path, partition_by="p")["inserted"] == len(rows)
    assert int(seen[0]) >= T.OPEN_FILES and spark.conf.get(name) == before
    table = T.read_table(spark, path, df.schema)
    latest = T.latest_rows(table, ["k", "l", "p"])
    assert sorted(map(str, latest.collect())) == sorted(str(r) for r in df.where("v >= 20").collect())
    plan = latest._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert plan.rindex("REBALANCE") > plan.rindex("Sort [") and plan.count("Exchange") == 2
