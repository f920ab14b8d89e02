from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluice import drop_feed_columns, duplicate_keys, keep_changes, latest_per_key, table_changes, upsert
from sluice.operators.changes import TAKEN_UP_COMPAT
from tests.helpers import rows

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
key = st.one_of(st.none(), st.integers(0, 5))
row = st.tuples(key, st.sampled_from(["x", "y"]), st.integers(0, 3))
KEYS = ["k", "c"]
SCHEMA = "k int, c string, v int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def by_key(data):
    return {(r[0], r[1]): r for r in data if r[0] is not None}


def unique(data):
    return [*by_key(data).values(), *[r for r in data if r[0] is None]]


@few
@given(st.lists(row, max_size=25), st.lists(row, max_size=25))
def test_upsert_against_a_dict(spark, before, new):
    before, new = unique(before), unique(new)
    table = by_key(before) | by_key(new)
    expected = [*table.values(), *[r for r in before + new if r[0] is None]]
    assert rows(upsert(frame(spark, before), frame(spark, new), KEYS)) == Counter(expected)


@few
@given(st.lists(row, max_size=25), st.lists(row, max_size=25))
def test_upsert_keeping_a_column(spark, before, new):
    before, new = unique(before), unique(new)
    old = by_key(before)
    merged = old | {k: (*k, old[k][2] if k in old else r[2]) for k, r in by_key(new).items()}
    expected = [*merged.values(), *[r for r in before + new if r[0] is None]]
    assert rows(upsert(frame(spark, before), frame(spark, new), KEYS, keep=["v"])) == Counter(expected)


def test_upsert_replaces_every_copy_by_one_row(spark):
    target = frame(spark, [(1, "x", 1), (1, "x", 2), (2, "x", 3)])
    source = frame(spark, [(1, "x", 9)])
    assert rows(upsert(target, source, KEYS)) == Counter([(1, "x", 9), (2, "x", 3)])


def test_upsert_keeps_a_null_value_too(spark):
    target = frame(spark, [(1, "x", None)])
    assert rows(upsert(target, frame(spark, [(1, "x", 9)]), KEYS, keep=["v"])) == Counter([(1, "x", None)])


def test_odd_key_names(spark):
    names = ["a.b", "c d", "e`f"]
    target = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (None, "x", 3)], "k int, c string, v int").toDF(*names)
    source = spark.createDataFrame([(1, "x", 9), (None, "x", 8)], "k int, c string, v int").toDF(*names)
    merged = upsert(target, source, names[:2])
    assert merged.columns == names
    assert rows(merged) == Counter([(1, "x", 9), (2, "x", 2), (None, "x", 3), (None, "x", 8)])
    kept = upsert(target, source, names[:2], keep=names[2:])
    assert rows(kept) == Counter([(1, "x", 1), (2, "x", 2), (None, "x", 3), (None, "x", 8)])
    both = target.unionByName(source)
    assert rows(duplicate_keys(both, names[:2])) == Counter([(1, "x", 2)])
    assert rows(latest_per_key(both, names[:2], names[2:])) == Counter([(1, "x", 9), (2, "x", 2), (None, "x", 8)])
    assert table_changes(target, source, names[:2]).count() == 5


def test_upsert_matches_columns_by_name(spark):
    source = frame(spark, [(1, "x", 9)]).select("v", "c", "k")
    assert rows(upsert(frame(spark, [(1, "x", 1)]), source, KEYS)) == Counter([(1, "x", 9)])


@few
@given(st.lists(st.tuples(key, st.sampled_from(["x", "y"]), st.integers(0, 3), st.integers(0, 4)), max_size=30))
def test_latest_per_key(spark, data):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], f"{SCHEMA}, at int, id int")
    best = {}
    loose = []
    for i, r in enumerate(data):
        if r[0] is None:
            loose.append((*r, i))
        elif (r[0], r[1]) not in best or best[r[0], r[1]][3:] < (r[3], i):
            best[r[0], r[1]] = (*r, i)
    got = latest_per_key(df, KEYS, order=["at", "id"], row_id=["id"])
    assert got.columns == df.columns
    assert rows(got) == Counter([*best.values(), *loose])


def test_latest_per_key_without_row_ids_groups_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k int, at int")
    assert rows(latest_per_key(df, ["k"], order=["at"])) == Counter([(None, 2)])


def test_duplicate_keys_pass_over_null_keys(spark):
    df = frame(spark, [(1, "x", 1), (1, "x", 2), (1, "y", 3), (None, "x", 4), (None, "x", 5)])
    assert rows(duplicate_keys(df, KEYS)) == Counter([(1, "x", 2)])


@few
@given(st.lists(row, max_size=25), st.lists(row, max_size=25))
def test_table_changes_against_counters(spark, before, after):
    old, new = Counter(before), Counter(after)
    gone, come = old - new, new - old
    gone_keys = {r[:2] for r in gone if r[0] is not None}
    come_keys = {r[:2] for r in come if r[0] is not None}
    both = gone_keys & come_keys
    expected = Counter()
    for r, n in gone.items():
        expected[(*r, "update_preimage" if r[:2] in both else "delete", n)] += 1
    for r, n in come.items():
        expected[(*r, "update_postimage" if r[:2] in both else "insert", n)] += 1
    assert rows(table_changes(frame(spark, before), frame(spark, after), KEYS)) == expected


@few
@given(st.lists(row, max_size=25), st.lists(row, max_size=25))
def test_changes_replayed_give_the_later_table(spark, before, after):
    before = list(by_key(before).values())
    after = list(by_key(before + after).values())  # nothing deleted
    feed = table_changes(frame(spark, before), frame(spark, after), KEYS)
    replayed = upsert(frame(spark, before), drop_feed_columns(keep_changes(feed)), KEYS)
    assert rows(replayed) == Counter(after)


def test_change_filter(spark):
    types = ["insert", "update_preimage", "update_postimage", "delete"]
    schema = "v int, _change_type string, _commit_version int, _own int"
    feed = spark.createDataFrame([(i, t, 1, 1) for i, t in enumerate(types)], schema)
    assert [r.v for r in keep_changes(feed).orderBy("v").collect()] == [0, 2]
    assert [r.v for r in keep_changes(feed, TAKEN_UP_COMPAT).collect()] == [0]
    assert drop_feed_columns(feed).columns == ["v", "_own"]
