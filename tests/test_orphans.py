from datetime import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodegraph.operators import orphans

PARENTS = "key string, arrived timestamp, gone timestamp"
REFS = "ref_table string, row_id long, key string, at timestamp"


def day(n):
    return None if n is None else dt(2024, 1 + n // 28, 1 + n % 28, 12)


def brute(parents, refs):
    out = set()
    for table, row, key, at in refs:
        mine = [(a, g) for k, a, g in parents if k == key]
        arrived = [(a, g) for a, g in mine if a is not None and at is not None and a <= at]
        if any(g is None or g > at for a, g in arrived):
            continue
        reason = "missing" if not mine else "late" if not arrived else "deleted"
        out.add((table, row, reason, at.strftime("%Y-%m") if at else None))
    return out


def found(spark, parents, refs, period="day"):
    p, r = spark.createDataFrame(parents, PARENTS), spark.createDataFrame(refs, REFS)
    return {tuple(x) for x in orphans.orphan_references(r, p, period).select("ref_table", "row_id", "reason", "period").collect()}


def test_reasons(spark):
    parents = [("a", day(1), day(5)), ("a", day(9), None), ("b", None, None), ("c", day(3), day(2)), ("d", day(4), None), ("d", day(4), None)]
    refs = [("t", i, k, day(n)) for i, (k, n) in enumerate([("a", 0), ("a", 1), ("a", 5), ("a", 9), ("b", 3), ("c", 3), ("d", 4), ("x", 1), ("a", None)])]
    assert found(spark, parents, refs) == brute(parents, refs)
    assert ("t", 2, "deleted", "2024-01") in found(spark, parents, refs)


def test_empty_tables(spark):
    assert found(spark, [], []) == set()
    assert found(spark, [], [("t", 1, "a", day(1))]) == {("t", 1, "missing", "2024-01")}
    assert found(spark, [("a", day(1), None)], []) == set()


@settings(max_examples=9, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    parents=st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 60)), st.one_of(st.none(), st.integers(0, 60))), max_size=12),
    refs=st.lists(st.tuples(st.sampled_from("abcd"), st.one_of(st.none(), st.integers(0, 60))), max_size=12),
    period=st.sampled_from(["day", "month"]),
    hot=st.sampled_from([0, 2, orphans.HOT_EVENTS]),
)
def test_against_brute_force(spark, parents, refs, period, hot):
    """Also with periods that are divided because their key is hot."""
    with pytest.MonkeyPatch.context() as m:
        m.setattr(orphans, "HOT_EVENTS", hot)
        against_brute_force(spark, parents, refs, period)


def against_brute_force(spark, parents, refs, period):
    ps = [(k, day(a), day(g)) for k, a, g in parents]
    rs = [("t", i, k, day(n)) for i, (k, n) in enumerate(refs)]
    assert found(spark, ps, rs, period) == brute(ps, rs)


def test_keys_are_cleaned_and_extra_columns_ignored(spark):
    chunk = spark.createDataFrame([(1, " A ", None, day(1), None, "x", "y"), (2, "", "b", day(1), None, "x", "y")], "row_id long, chunk_id string, split_from string, t timestamp, d timestamp, key string, arrived string")
    keys = {r.key for r in orphans.parent_rows(chunk, ["chunk_id", "split_from"], "t", "d").collect()}
    assert keys == {"a", "b"}
    refs = orphans.references(chunk, "chunk", "row_id", "chunk_id", "t").collect()
    assert [(r.row_id, r.key) for r in refs] == [(1, "a")]


def test_pending_months_balance(spark):
    parents = spark.createDataFrame([("a", day(30), day(60)), ("b", day(2), None)], PARENTS)
    refs = spark.createDataFrame([("t", 1, "a", day(1)), ("t", 2, "a", day(31)), ("t", 3, "b", day(1)), ("t", 4, "z", day(5))], REFS)
    rows = {r.period: r for r in orphans.pending_by_month(refs, parents).collect()}
    assert (rows["2024-01"].opened, rows["2024-01"].resolved, rows["2024-01"].pending) == (3, 1, 2)
    assert (rows["2024-02"].resolved, rows["2024-02"].pending) == (1, 1)
    assert (rows["2024-03"].reopened, rows["2024-03"].pending) == (2, 3)
