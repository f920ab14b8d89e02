"""Whole runs: files to the raw table to the typed table."""

from __future__ import annotations

import datetime as dt
import json
from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from checks.stores import snapshot_store
from sluice import (
    BronzeTable,
    Contract,
    Field,
    Layout,
    SilverTable,
    raise_failures,
    read_typed,
    register_views,
    run_bronze,
    run_silver,
    summarize,
)
from sluice.operators.upsert import unmatched
from sluice.sources import log
from sluice.sources import silver as silver_module
from sluice.sources.silver import FEW, bucket_count, bucket_sizes
from tests.helpers import MEMBERS, RESULTS, Desk, rows

KV = Contract((Field("k", "string", is_primary_key=True), Field("v", "integer"), Field("w", "string")))


def typed(desk):
    return rows(read_typed(desk.spark, desk.dataset, desk.layout))


def silver(desk):
    return SilverTable(desk.spark, desk.layout.typed_of(desk.dataset))


def test_golden_single_key(spark, tmp_path):
    """Blank header cells at the end, dates in one format, marks with and without decimals."""
    desk = Desk(spark, tmp_path, MEMBERS)
    desk.put(
        "members.csv",
        "member_id,given_name,born_on,points,joined_on,,\n"
        "M-01,Ada,03/04/1999,285,15/01/2024,,\n"
        "M-02,Ben,29/02/2000,235.5,16/01/2024,,\n"
        "M-03,Cy,31/12/2001,,17/01/2024,,\n",
    )
    status = desk.run()
    assert (status.state, status.version, status.rows) == ("loaded", 0, 3)
    table = read_typed(spark, desk.dataset, desk.layout)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in MEMBERS.to_struct()]
    assert rows(table) == Counter(
        [
            ("M-01", "Ada", dt.date(1999, 4, 3), Decimal("285.00"), dt.date(2024, 1, 15)),
            ("M-02", "Ben", dt.date(2000, 2, 29), Decimal("235.50"), dt.date(2024, 1, 16)),
            ("M-03", "Cy", dt.date(2001, 12, 31), None, dt.date(2024, 1, 17)),
        ]
    )


def test_golden_composite_key(spark, tmp_path):
    """No newline at the end of the file; the second load updates one row and adds one."""
    desk = Desk(spark, tmp_path, RESULTS, "results")
    desk.put(
        "results.csv",
        "member_id,event_code,score,held_on\n"
        "M-01,RUN,95.0,15/02/2024\nM-01,SWIM,92.0,16/02/2024\nM-02,RUN,80.5,15/02/2024",
    )
    desk.run()
    desk.put("late.csv", "held_on,score,event_code,member_id\n18/02/2024,81,RUN,M-02\n16/02/2024,7,SWIM,M-02\n")
    assert desk.run().rows == 2
    day = dt.date
    assert typed(desk) == Counter(
        [
            ("M-01", "RUN", Decimal("95.00"), day(2024, 2, 15)),
            ("M-01", "SWIM", Decimal("92.00"), day(2024, 2, 16)),
            ("M-02", "RUN", Decimal("81.00"), day(2024, 2, 18)),
            ("M-02", "SWIM", Decimal("7.00"), day(2024, 2, 16)),
        ]
    )


def test_a_run_without_new_files_changes_nothing(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\n")
    desk.run()
    before = silver(desk).loads().count()
    status = desk.run()
    assert (status.state, status.version) == ("up_to_date", 0)
    assert silver(desk).loads().count() == before
    assert typed(desk) == Counter([("A", 1, "x")])


def test_several_versions_of_a_key_between_loads(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\nA,2,x\nB,1,x\n")
    desk.take_up()
    desk.put("b.csv", "k,v,w\nA,3,x\nC,1,x\nA,4,x\n")
    desk.take_up()
    desk.put("aa.csv", "k,v,w\nA,5,x\n")
    desk.take_up()
    assert desk.load().rows == 3
    assert typed(desk) == Counter([("A", 5, "x"), ("B", 1, "x"), ("C", 1, "x")])
    # Later lines of a file, and files modified later, within one version.
    desk.put("m2.csv", "k,v,w\nB,8,x\nC,7,x\n")
    desk.put("m1.csv", "k,v,w\nB,7,x\nB,6,x\n")
    desk.run()
    assert typed(desk) == Counter([("A", 5, "x"), ("B", 6, "x"), ("C", 7, "x")])


def test_duplicates_as_an_error(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV, on_duplicate="error")
    desk.put("a.csv", "k,v,w\nA,1,x\nB,1,x\n")
    desk.run()
    desk.put("b.csv", "k,v,w\nA,2,x\n")
    desk.run()
    assert typed(desk) == Counter([("A", 2, "x"), ("B", 1, "x")])
    desk.put("c.csv", "k,v,w\nA,3,x\nA,4,x\n")
    desk.take_up()
    (status,) = run_silver(spark, [desk.dataset], desk.layout)
    assert status.state == "failed"
    assert "'k': 'A'" in status.detail
    assert typed(desk) == Counter([("A", 2, "x"), ("B", 1, "x")])
    with pytest.raises(RuntimeError, match="failed: members"):
        raise_failures([status])


def test_null_keys_are_added_by_each_load(spark, tmp_path):
    keys = (Field("k", "integer", is_primary_key=True), Field("c", "string", is_primary_key=True))
    contract = Contract((*keys, Field("v", "integer")))
    desk = Desk(spark, tmp_path, contract)
    desk.put("a.csv", "k,c,v\nbad,x,1\nbad,x,1\n1,,2\n1,x,3\n")
    desk.run()
    desk.put("b.csv", "k,c,v\nbad,x,1\n1,x,4\n")
    desk.run()
    desk.put("c.csv", "k,c,v\n,,5\n")
    desk.run()
    assert typed(desk) == Counter(
        {(None, "x", 1): 3, (1, None, 2): 1, (1, "x", 4): 1, (None, None, 5): 1}
    )


def test_a_missing_column_overwrites_by_default(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\nB,1,y\n")
    desk.run()
    desk.put("b.csv", "k,v\nA,2\nC,3\n")
    desk.run()
    assert typed(desk) == Counter([("A", 2, None), ("B", 1, "y"), ("C", 3, None)])


def test_a_missing_column_can_be_kept(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV, keep_when_missing=True)
    desk.put("a.csv", "k,v,w\nA,1,x\nB,1,y\n,9,z\n")
    desk.run()
    desk.put("b.csv", "k,v\nA,2\nC,3\n,8\n")
    desk.run()
    desk.put("c.csv", "k,v,w\nB,4,\n")
    desk.run()
    assert typed(desk) == Counter([("A", 2, "x"), ("B", 4, None), ("C", 3, None), (None, 9, "z"), (None, 8, None)])


def test_a_lost_typed_table_is_built_again_in_full(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\n")
    desk.run()
    desk.put("b.csv", "k,v,w\nB,2,x\n")
    desk.run()
    table = silver(desk)
    # The same log, another data directory: to the pipeline the rows are gone.
    orphan = SilverTable(spark, f"{desk.layout.typed}/orphan_silver")
    for entry in table.loads().drop("written_at").toJSON().collect():
        orphan.log.append(json.loads(entry))
    assert not orphan.exists()
    lost = replace(desk.dataset, name="orphan")
    desk.put("c.csv", "k,v,w\nC,3,x\n")
    desk.take_up()
    raise_failures(run_silver(spark, [lost], desk.layout))
    assert rows(read_typed(spark, lost, desk.layout)) == Counter([("A", 1, "x"), ("B", 2, "x"), ("C", 3, "x")])


def test_versions_without_rows_are_logged(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV)
    desk.put("head0.csv", "k,v,w\n")
    assert desk.run().state == "empty"
    desk.put("a.csv", "k,v,w\nA,1,x\n")
    desk.run()
    desk.put("head1.csv", "k,v,w\n")
    assert desk.run().state == "empty"
    assert desk.run().state == "up_to_date"
    assert [r.kind for r in silver(desk).loads().orderBy("load").collect()] == ["full", "empty"]
    desk.put("b.csv", "k,v,w\nA,2,x\n")
    desk.run()
    assert typed(desk) == Counter([("A", 2, "x")])


def test_contract_changes(spark, tmp_path):
    narrow = Contract(KV.fields[:2])
    desk = Desk(spark, tmp_path, narrow)
    desk.put("a.csv", "k,v,w\nA,1,x\nB,2,y\n")
    desk.run()
    desk.dataset = replace(desk.dataset, contract=KV)
    desk.put("b.csv", "k,v,w\nB,3,z\n")
    desk.run()
    assert typed(desk) == Counter([("A", 1, None), ("B", 3, "z")])
    changed = Contract((KV.fields[0], Field("v", "long"), KV.fields[2]))
    (status,) = run_silver(spark, [replace(desk.dataset, contract=changed)], desk.layout)
    assert status.state == "failed"
    assert "changed from int to bigint" in status.detail


def test_gates(spark, tmp_path):
    layout = Layout.under(f"file:{tmp_path}")
    desk = Desk(spark, tmp_path, KV)
    unkeyed = Contract((Field("k", "string"),))
    odd = Contract((Field("k", "varchar", is_primary_key=True),))
    datasets = [
        replace(desk.dataset, name="a", raw_name="ra", contract=None),
        replace(desk.dataset, name="b", raw_name="rb", contract=Contract(())),
        replace(desk.dataset, name="c", raw_name="rc", contract=unkeyed),
        replace(desk.dataset, name="d", raw_name="rd", contract=odd),
        replace(desk.dataset, name="e", raw_name="re"),
    ]
    statuses = run_silver(spark, datasets, layout)
    assert [(s.dataset, s.state, s.detail) for s in statuses] == [
        ("a", "skipped", "no contract"),
        ("b", "skipped", "no contract"),
        ("c", "skipped", "no primary key"),
        ("d", "failed", "column 'k': unknown contract type 'varchar'"),
        ("e", "skipped", "no raw table"),
    ]
    assert summarize(spark, datasets, layout).count() == 0
    assert run_silver(spark, [], layout) == []


def test_many_datasets_summary_and_views(spark, tmp_path):
    members = Desk(spark, tmp_path, MEMBERS)
    results = Desk(spark, tmp_path, RESULTS, "results")
    members.put("a.csv", "member_id,points\nM-01,187\nM-02,80.5\n")
    results.put("a.csv", "member_id,event_code,score\nM-01,RUN,95\nM-01,SWIM,92\nM-02,RUN,80.5\n")
    datasets = [members.dataset, results.dataset]
    raise_failures(run_bronze(spark, datasets, members.layout))
    raise_failures(run_silver(spark, datasets, members.layout))
    assert rows(summarize(spark, datasets, members.layout)) == Counter([("members", 2), ("results", 3)])
    views = register_views(spark, datasets, members.layout, namespace="typed_tables")
    assert views == ["typed_tables.members_silver", "typed_tables.results_silver"]
    assert spark.catalog.databaseExists("typed_tables")
    assert register_views(spark, datasets, members.layout) == ["members_silver", "results_silver"]
    for name in ("members_silver", "results_silver"):
        assert rows(spark.table(f"typed_tables.{name}")) == rows(spark.table(name))
    # The scores of a member add up to the member's points.
    wrong = spark.sql(
        """SELECT m.member_id FROM members_silver m JOIN
           (SELECT member_id, sum(score) AS total FROM results_silver GROUP BY member_id) r
           ON m.member_id = r.member_id WHERE m.points <> r.total"""
    )
    assert wrong.count() == 0


def test_buckets_are_rewritten_only_if_touched(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sluice.sources.silver.BUCKET_BYTES", 2000)
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\n" + "".join(f"K{i},{i},x\n" for i in range(4000)))
    desk.run()
    state = silver(desk).state()
    assert state.buckets > 8
    assert state.buckets % 8 == 0
    desk.put("b.csv", "k,v,w\nK7,-7,y\nNEW,1,y\n")
    desk.run()
    loads = silver(desk).loads().orderBy("load").collect()
    assert len(loads[0].written) == state.buckets
    assert len(loads[1].written) <= 2
    assert typed(desk) == Counter(
        [(f"K{i}", -7 if i == 7 else i, "y" if i == 7 else "x") for i in range(4000)] + [("NEW", 1, "y")]
    )
    # One file per bucket from the first load: the shuffle on the key is also the bucket's.
    files = spark.read.parquet(f"{silver(desk).data}/_load=0").select(F.input_file_name()).distinct()
    assert files.count() == state.buckets


def test_a_table_that_outgrows_its_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sluice.sources.silver.BUCKET_BYTES", 6000)
    desk = Desk(spark, tmp_path, KV, keep_when_missing=True)
    desk.put("a.csv", "k,v,w\nK1,1,x\nK2,2,x\n,1,loose\n")
    desk.run()
    assert silver(desk).state().buckets == 1
    desk.put("b.csv", "k,v\n" + "".join(f"K{i},{-i}\n" for i in range(2, 7000)) + ",2\n")
    desk.run()
    state = silver(desk).state()
    assert state.buckets >= 4
    assert (state.load, state.base_load) == (1, 1)
    expected = {f"K{i}": (f"K{i}", -i, "x" if i == 2 else None) for i in range(2, 7000)}
    expected["K1"] = ("K1", 1, "x")
    loose = [(None, 1, "loose"), (None, 2, None)]
    assert typed(desk) == Counter([*expected.values(), *loose])
    desk.put("c.csv", "k,v,w\nK5,5,y\n")
    desk.run()
    expected["K5"] = ("K5", 5, "y")
    assert typed(desk) == Counter([*expected.values(), *loose])
    last = silver(desk).loads().orderBy(F.desc("load")).first()
    assert (last.kind, len(last.written)) == ("merge", 1)
    # Of the first load nothing is read any more, of the second not the bucket of K5.
    old = {row.path.split("/data/")[1] for row in silver(desk).superseded().collect()}
    assert old == {"_load=0/_bucket=-1", "_load=0/_bucket=0", f"_load=1/_bucket={last.written[0]}"}


def test_compaction_and_both_join_strategies_agree(spark, tmp_path, monkeypatch, settings):
    monkeypatch.setattr("sluice.sources.silver.BUCKET_BYTES", 200)
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    desk = Desk(spark, tmp_path, KV)
    expected = {}
    for wave in range(4):
        lines = {f"K{i}": (i + wave, "x") for i in range(wave * 20, wave * 20 + 60)}
        expected |= lines
        desk.put(f"f{wave}.csv", "k,v,w\n" + "".join(f"{k},{v},{w}\n" for k, (v, w) in lines.items()) + ",1,loose\n")
        desk.take_up()
        monkeypatch.setattr(
            "sluice.plans.pipeline.SilverTable", lambda spark, root: SilverTable(spark, root, compact_every=2)
        )
        desk.load()
        monkeypatch.undo()
        monkeypatch.setattr("sluice.sources.silver.BUCKET_BYTES", 200)
    assert typed(desk) == Counter({(k, v, w): 1 for k, (v, w) in expected.items()} | {(None, 1, "loose"): 4})


@pytest.mark.parametrize("tasks", [1, 8, 200, 997, 1009, 2000, 4001, 32_749])
def test_bucket_counts_follow_the_size_alone(tasks):
    for size in (0, 1 << 30, 5 << 30, 100 << 30, 900 << 30, 5000 << 30, 100 << 40):
        wanted = min(1 << 14, max(1, -(-size // (256 << 20))))
        buckets = bucket_count(size, tasks, 256 << 20)
        assert wanted <= buckets <= min(1 << 14, 2 * wanted)
    assert bucket_count(100 << 30, 200, 256 << 20) == 400


def test_the_same_keys_landed_again_leave_the_buckets_alone(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV, bucket_bytes=4000)
    counts = set()
    for wave in range(10):
        desk.put(f"f{wave}.csv", "k,v,w\n" + "".join(f"K{i},{wave},x\n" for i in range(2000)))
        desk.run()
        counts.add(silver(desk).state().buckets)
    assert len(counts) == 1 and counts.pop() >= 4
    assert typed(desk) == Counter([(f"K{i}", 9, "x") for i in range(2000)])


def test_loads_cost_the_same_however_many_there_were(spark, tmp_path):
    """Jobs of a stage, and directories that the table is read from, after many loads."""
    desk = Desk(spark, tmp_path, KV)

    def jobs(stage) -> int:
        scheduler = spark.sparkContext._jsc.sc().dagScheduler()
        before = scheduler.numTotalJobs()
        stage()
        return scheduler.numTotalJobs() - before

    spent = []
    for wave in range(24):
        desk.put(f"f{wave}.csv", f"k,v,w\nA,{wave},x\n,{wave},loose\n")
        spent.append((jobs(desk.take_up), jobs(desk.load)))
    assert max(first for first, _ in spent) <= 6
    assert max(second for _, second in spent) <= 8
    assert len({first for first, _ in spent}) == 1
    assert len(silver(desk).state().places) <= 2 + 16
    assert typed(desk) == Counter([("A", 23, "x"), *[(None, i, "loose") for i in range(24)]])


def test_a_load_tells_what_was_missing(spark, tmp_path):
    contract = Contract(
        (
            Field("k", "string", is_primary_key=True),
            Field("n", "integer", nullable=False),
            Field("day", "date", date_formats=("dd/MM/yyyy",)),
            Field("note", "string", nullable=False),
        )
    )
    desk = Desk(spark, tmp_path, contract)
    desk.put("a.csv", "k,n,dya,note\nA,1,01/02/2024,x\nB,one,02/02/2024,\n")
    status = desk.run()
    assert status.absent == ("day",)
    assert status.unreadable == {"n": 1}
    assert status.null_violations == {"n": 1, "note": 1}
    assert status.detail == (
        "not in the files: day; unreadable values: n (1); NULL but declared not to be: n (1), note (1)"
    )
    desk.put("b.csv", "k,n,day,note\nA,1,01/02/2024,x\n")
    assert desk.run().detail == ""


@pytest.mark.parametrize("again", ["long", "decimal(5,2)"])
def test_a_dropped_column_comes_back(spark, tmp_path, again):
    """Empty in every bucket, and only with the type it had."""
    key = Field("k", "string", is_primary_key=True)
    full = Contract((key, Field("v", "integer"), Field("x", "long")))
    desk = Desk(spark, tmp_path, full, bucket_bytes=300)
    desk.put("a.csv", "k,v,x\n" + "".join(f"K{i},{i},{i}\n" for i in range(300)))
    desk.run()
    assert silver(desk).state().buckets >= 4
    desk.dataset = replace(desk.dataset, contract=Contract(full.fields[:2]))
    desk.put("b.csv", "k,v,x\nK1,-1,-1\n")
    desk.run()
    assert read_typed(spark, desk.dataset, desk.layout).columns == ["k", "v"]
    desk.dataset = replace(desk.dataset, contract=Contract((key, Field("v", "integer"), Field("x", again))))
    desk.put("c.csv", "k,v,x\nK2,-2,-2\n")
    desk.take_up()
    before = silver(desk).loads().count()
    (status,) = run_silver(spark, [desk.dataset], desk.layout)
    if again == "long":
        assert status.state == "loaded"
        expected = {f"K{i}": (f"K{i}", i, None) for i in range(300)}
        expected |= {"K1": ("K1", -1, None), "K2": ("K2", -2, -2)}
        assert typed(desk) == Counter(expected.values())
        register_views(spark, [desk.dataset], desk.layout, "back")
        assert rows(spark.table("back.members_silver")) == Counter(expected.values())
    else:
        assert status.state == "failed" and "'x' changed from bigint to decimal(5,2)" in status.detail
        assert silver(desk).loads().count() == before


def test_times_are_read_in_the_zone_of_the_run(spark, tmp_path, settings):
    settings("spark.sql.session.timeZone", "Asia/Tokyo")
    contract = Contract((Field("k", "string", is_primary_key=True), Field("at", "timestamp")))
    desk = Desk(spark, tmp_path, contract)
    desk.put("a.csv", "k,at\nA,2024-01-01 12:00:00\n")
    desk.run()
    desk.put("b.csv", "k,at\nB,2024-01-01 12:00:00\n")
    desk.take_up()
    raise_failures(run_silver(spark, [desk.dataset], desk.layout, time_zone="America/New_York"))
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    got = read_typed(spark, desk.dataset, desk.layout).select("k", F.unix_timestamp("at").alias("s")).collect()
    noon = 1704110400
    assert {r.k: r.s for r in got} == {"A": noon, "B": noon + 5 * 3600}


def test_another_store_may_stand_in(spark, tmp_path):
    class Loud(SilverTable):
        calls: list[str] = []

        def write_full(self, *args, **kwargs):
            self.calls.append("full")
            return super().write_full(*args, **kwargs)

        def merge(self, *args, **kwargs):
            self.calls.append("merge")
            return super().merge(*args, **kwargs)

    desk = Desk(spark, tmp_path, KV)
    for name in ("a", "b"):
        desk.put(f"{name}.csv", f"k,v,w\n{name},1,x\n")
        desk.take_up()
        make = lambda spark, dataset, layout: Loud(spark, layout.typed_of(dataset))
        raise_failures(run_silver(spark, [desk.dataset], desk.layout, store=make))
    assert Loud.calls == ["full", "merge"]


def test_another_store_is_read_through_itself(spark, tmp_path):
    """Everything that looks at a typed table asks the store that it was loaded into."""
    desk = Desk(spark, tmp_path, KV)
    store = {"store": snapshot_store}
    for name, value in (("a", 1), ("b", 2), ("a", 3)):
        desk.put(f"{name}{value}.csv", f"k,v,w\n{name},{value},x\n")
        desk.take_up()
        raise_failures(run_silver(spark, [desk.dataset], desk.layout, namespace="another", **store))
    want = Counter([("a", 3, "x"), ("b", 2, "x")])
    assert rows(read_typed(spark, desk.dataset, desk.layout, **store)) == want
    assert rows(spark.table("another.members_silver")) == want
    assert rows(summarize(spark, [desk.dataset], desk.layout, **store)) == Counter([("members", 2)])
    assert register_views(spark, [desk.dataset], desk.layout, **store) == ["members_silver"]
    assert rows(spark.table("members_silver")) == want
    # the table of the library was never made
    assert not silver(desk).exists()
    with pytest.raises(ValueError, match="holds no table"):
        read_typed(spark, desk.dataset, desk.layout)


def test_a_run_leaves_the_settings_of_the_session_alone(spark, tmp_path, settings):
    """Also while it is under way, and it takes over those that the session has."""
    settings("spark.sql.session.timeZone", "Asia/Tokyo")
    settings("spark.sql.shuffle.partitions", "3")
    seen = []

    def store(session, dataset, layout):
        names = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions")
        seen.append(tuple(one.conf.get(name) for one in (session, spark) for name in names))
        return SilverTable(session, layout.typed_of(dataset))

    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\n")
    desk.take_up()
    raise_failures(run_silver(spark, [desk.dataset], desk.layout, store=store))
    assert seen == [("UTC", "3", "Asia/Tokyo", "3")]


def test_an_empty_load_into_another_store(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV)
    for wave in ("k,v,w\n", "k,v,w\na,1,x\n", "k,v,w\n", "k,v,w\na,2,x\n"):
        desk.put(f"f{desk.clock}.csv", wave)
        desk.take_up()
        raise_failures(run_silver(spark, [desk.dataset], desk.layout, store=snapshot_store))
    assert rows(read_typed(spark, desk.dataset, desk.layout, snapshot_store)) == Counter([("a", 2, "x")])


def test_views_follow_loads(spark, tmp_path):
    """A view of the catalog shows the rows of the last run, also where the run had nothing to load."""
    desk = Desk(spark, tmp_path, KV)
    view = "select.members_silver"
    follow = {"namespace": "select"}
    assert run_silver(spark, [desk.dataset], desk.layout, **follow)[0].state == "skipped"
    desk.put("a.csv", "k,v,w\nA,1,x\n")
    desk.take_up()
    raise_failures(run_silver(spark, [desk.dataset], desk.layout, **follow))
    shown = spark.table("`select`.members_silver")
    assert rows(shown) == Counter([("A", 1, "x")])
    desk.put("b.csv", "k,v,w\nA,2,x\nB,1,y\n")
    desk.run()  # a run that does not know of the view
    raise_failures(run_silver(spark, [desk.dataset], desk.layout, **follow))
    assert rows(spark.table("`select`.members_silver")) == Counter([("A", 2, "x"), ("B", 1, "y")])
    assert register_views(spark, [desk.dataset], desk.layout, "select") == [view]
    wider = Contract((*KV.fields, Field("new", "string")))
    desk.dataset = replace(desk.dataset, contract=wider)
    desk.put("c.csv", "k,v,w,new\nC,3,z,n\n")
    desk.take_up()
    raise_failures(run_silver(spark, [desk.dataset], desk.layout, **follow))
    assert spark.table("`select`.members_silver").columns == ["k", "v", "w", "new"]


def test_file_system_calls_of_a_merge_do_not_grow_with_the_buckets(spark, tmp_path, monkeypatch):
    """Neither the driver's own calls nor the paths that it hands to readers, which look each of them up."""
    calls, paths = [], []
    place, load = log._place, DataFrameReader.load
    monkeypatch.setattr(log, "_place", lambda *args: calls.append(args) or place(*args))
    parquet = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *some, **o: paths.extend(some) or parquet(self, *some, **o))
    monkeypatch.setattr(DataFrameReader, "load", lambda self, path=None, *a, **o: paths.append(path) or load(self, path, *a, **o))
    spent = []
    for buckets in (8, 128, 512):
        table = SilverTable(spark, f"file:{tmp_path}/{buckets}", bucket_bytes=1 << 20)
        first = spark.range(6000).selectExpr("id AS k", "'old' AS v")
        table.write_full(None, first, ["k"], 0, size=buckets << 20)
        state = table.state()
        assert state.buckets == buckets and len(state.places) == buckets
        calls.clear()
        paths.clear()
        of_bucket = F.pmod(F.hash("id"), F.lit(buckets))
        for version, (value, share) in enumerate((("new", 0.75), ("last", 0.5)), 1):
            some = spark.range(7000).filter(of_bucket < share * buckets)
            table.merge(table.state(), some.select(F.col("id").alias("k"), F.lit(value).alias("v")), ["k"], version)
        got = table.read().groupBy("v").count().collect()
        spent.append((len(calls), len(paths)))
        assert sum(r["count"] for r in got) > 6000 and {r.v for r in got} == {"old", "new", "last"}
    assert spent[1] == spent[2]
    # a few directories are listed one by one in place of a job
    assert FEW <= 32 and spent[0][0] == spent[1][0] and spent[0][1] < spent[1][1]


@pytest.mark.parametrize("few", [0, 1000])
def test_sizes_by_a_job_and_by_the_driver_agree(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr("sluice.sources.silver.FEW", few)
    place = f"file:{tmp_path}/load"
    spark.range(500).selectExpr("id", "cast(id % 40 - 1 as int) AS _bucket").write.partitionBy("_bucket").parquet(place)
    found = {}
    for path in (tmp_path / "load").rglob("*.parquet"):
        bucket = int(path.parent.name.removeprefix("_bucket="))
        found[bucket] = found.get(bucket, 0) + path.stat().st_size
    assert bucket_sizes(spark, place) == found and len(found) == 40


def test_bucket_sizes_are_those_of_the_files(spark, tmp_path):
    table = SilverTable(spark, f"file:{tmp_path}/t [1]", bucket_bytes=1 << 20)
    rows_ = spark.range(900).selectExpr("if(id % 9 = 0, null, id) AS k", "'x' AS v")
    table.write_full(None, rows_, ["k"], 0, size=40 << 20)
    found = {}
    for path in (tmp_path / "t [1]" / "data" / "_load=0").rglob("*.parquet"):
        bucket = int(path.parent.name.removeprefix("_bucket="))
        found[bucket] = found.get(bucket, 0) + path.stat().st_size
    assert {p.bucket: p.bytes for p in table.state().places} == found and -1 in found and len(found) > 33
    table.merge(table.state(), spark.createDataFrame([(1, "y"), (2, "y")], "k long, v string"), ["k"], 1)
    assert table.read().count() == 900 and table.read().filter("v = 'y'").count() == 2
    table.write_full(table.state(), rows_.limit(0), ["k"], 2, size=0)
    assert table.read().count() == 0


@pytest.mark.parametrize("layout", ["buckets", "one bucket", "outgrown"])
@pytest.mark.parametrize("limit", ["1g", "-1"])
def test_keys_are_broadcast_in_slices_that_the_driver_can_hold(spark, tmp_path, monkeypatch, settings, layout, limit):
    """All the keys of a load were broadcast at once, whatever the driver's memory, if the limit allowed."""
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    monkeypatch.setattr(silver_module, "HEAP_PART", heap // 10_000, raising=False)
    settings("spark.sql.autoBroadcastJoinThreshold", limit)
    joined = []

    def noted(target, source, keys):
        joined.append(source.filter("k is not null").count())
        result = unmatched(target, source, keys)
        text = result._jdf.queryExecution().executedPlan().toString()
        assert "<empty>" in text or ("BroadcastHashJoin" in text) == (limit == "1g")
        return result

    monkeypatch.setattr(silver_module, "unmatched", noted)
    size = 1 << 20
    table = SilverTable(spark, f"file:{tmp_path}/t", compact_every=2, bucket_bytes=size)
    keys = F.expr("if(id % 50 = 0, null, id)").alias("k")
    first = spark.range(1500).select(keys, F.lit(0).alias("v"), F.lit("first").alias("w"))
    table.write_full(None, first, ["k"], 0, size=size if layout != "buckets" else 12 * size)
    want = {i: (i, 0, "first") for i in range(1500) if i % 50}
    loose = [(None, 0, "first")] * 30
    if layout == "outgrown":
        table.bucket_bytes = 1000
    for load, (start, end) in enumerate(((700, 2000), (0, 900), (5, 6)), 1):
        joined.clear()
        more = spark.range(start, end).select(keys, F.lit(load).alias("v"), F.lit(None).cast("string").alias("w"))
        table.merge(table.state(), more, ["k"], load, keep=["w"] if load == 2 else [])
        for i in range(start, end):
            if i % 50:
                want[i] = (i, load, want.get(i, (0, 0, None))[2] if load == 2 else None)
            else:
                loose.append((None, load, None))
        assert rows(table.read()) == Counter([*want.values(), *loose])
        # 48 bytes a key; shares of buckets are told by their files
        assert sum(joined) == sum(1 for i in range(start, end) if i % 50)
        assert max(joined) <= 1.5 * 10_000 / 48 or limit == "-1" and len(joined) == 1
    assert (table.state().buckets >= 4) == (layout != "one bucket")


def test_slices_hold_every_bucket_once():
    shares = {-1: 0, 0: 4.0, 1: 5.0, 2: 25.0, 3: 10.0, 4: 0, 5: 1.0}
    slices = silver_module.key_slices(shares, 10)
    assert [(s.buckets, s.part, s.of) for s in slices] == [
        ((-1, 0, 1), 0, 1), ((3, 4), 0, 1), ((5,), 0, 1), ((2,), 0, 3), ((2,), 1, 3), ((2,), 2, 3)
    ]
    assert [s.buckets for s in silver_module.key_slices({-1: 0}, 10)] == [(-1,)]


def fails_at(monkeypatch, target: str, after: bool):
    """Make a method raise, before or after its work."""
    from importlib import import_module

    module_name, class_name, method = target.rsplit(".", 2)
    owner = getattr(import_module(module_name), class_name)
    original = getattr(owner, method)

    def broken(self, *args, **kwargs):
        if after:
            original(self, *args, **kwargs)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(owner, method, broken)


@pytest.mark.parametrize("merging", [False, True])
def test_a_crash_before_the_load_is_logged(spark, tmp_path, monkeypatch, settings, merging):
    settings("spark.sql.sources.partitionOverwriteMode", "dynamic")
    monkeypatch.setattr("sluice.sources.silver.BUCKET_BYTES", 1)
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\nB,1,x\n,0,loose\n")
    if merging:
        desk.run()
        before = typed(desk)
        desk.put("b.csv", "k,v,w\nB,2,x\nC,2,x\n,0,loose\n")
    desk.take_up()
    # The rows are written, the entry is not.
    fails_at(monkeypatch, "sluice.sources.log.Log.append", after=False)
    (status,) = run_silver(spark, [desk.dataset], desk.layout)
    assert status.state == "failed"
    monkeypatch.undo()
    monkeypatch.setattr("sluice.sources.silver.BUCKET_BYTES", 1)
    if merging:
        assert typed(desk) == before
    else:
        assert not silver(desk).exists()
    # More arrives before the next run, which converges.
    desk.put("c.csv", "k,v,w\nC,3,x\n")
    desk.run()
    expected = Counter([("A", 1, "x"), ("B", 1, "x"), ("C", 3, "x"), (None, 0, "loose")])
    if merging:
        expected = Counter({("A", 1, "x"): 1, ("B", 2, "x"): 1, ("C", 3, "x"): 1, (None, 0, "loose"): 2})
    assert typed(desk) == expected


def test_a_crash_after_the_load_is_logged(spark, tmp_path, monkeypatch):
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\n,0,loose\n")
    desk.take_up()
    fails_at(monkeypatch, "sluice.sources.log.Log.append", after=True)
    run_silver(spark, [desk.dataset], desk.layout)
    monkeypatch.undo()
    assert desk.run().state == "up_to_date"
    assert typed(desk) == Counter([("A", 1, "x"), (None, 0, "loose")])


lines = st.lists(st.tuples(st.sampled_from(["", "A", "B", "C", "D", "E"]), st.integers(0, 9)), min_size=1, max_size=6)
steps = st.lists(st.tuples(lines, st.sampled_from(["none", "take", "run"])), min_size=1, max_size=4)


@hypothesis_settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps)
def test_any_series_of_files_and_runs_gives_the_same_table(spark, tmp_path_factory, series):
    """The typed table is what a dict makes of the lines, however the files fall into runs."""
    desk = Desk(spark, tmp_path_factory.mktemp("series"), KV, max_files=2)
    table, loose = {}, []
    for number, (written, action) in enumerate(series):
        names = ["k", "v"] if number % 2 else ["v", "k"]
        body = "".join(f"{k},{v}\n" if names[0] == "k" else f"{v},{k}\n" for k, v in written)
        desk.put(f"f{number:03}.csv", ",".join(names) + "\n" + body)
        for k, v in written:
            if k:
                table[k] = (k, v, None)
            else:
                loose.append((None, v, None))
        if action != "none":
            desk.take_up()
        if action == "run":
            desk.load()
            desk.load()
    desk.run()
    assert typed(desk) == Counter([*table.values(), *loose])


def test_a_commit_after_the_window_was_fixed_waits(spark, tmp_path, monkeypatch):
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\n")
    desk.take_up()
    desk.put("b.csv", "k,v,w\nB,2,x\n")
    desk.take_up()
    head = BronzeTable.head
    first = BronzeTable(spark, desk.layout.raw_of(desk.dataset)).commits().filter("version = 0").first()
    monkeypatch.setattr(BronzeTable, "head", lambda self: first)
    assert desk.load().version == 0
    assert typed(desk) == Counter([("A", 1, "x")])
    monkeypatch.setattr(BronzeTable, "head", head)
    assert desk.load().version == 1
    assert typed(desk) == Counter([("A", 1, "x"), ("B", 2, "x")])
