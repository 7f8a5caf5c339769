"""Copy-on-write merge by hash bucket: equal to the full state, untouched files stay."""

import json
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from perkflow.operators import cdc
from perkflow.session import scratch_path
from perkflow.sinks.merge import bucket_of, merge_changes, read_merged
from perkflow.sources import folders

SCHEMA = "employee_id long, v string, __op string, __source_ts_ms long, __source_lsn long, __deleted boolean"
KEYS = ["employee_id"]


def change(lsn, key, op="u"):
    return (key if op != "t" else None, f"v{lsn}", op, lsn * 1000, lsn, op == "d")


def frame(spark, changes):
    return spark.createDataFrame(changes, SCHEMA)


def rows(df):
    return sorted(map(repr, df.select("employee_id", "v", "__source_lsn", "updated_at").collect()))


def files(spark, root):
    found = {}
    for b in folders.child_folders(spark, root, "bucket="):
        fs, place = folders._at(spark, f"{root}/{b}")
        found[b] = sorted(s.getPath().getName() for s in fs.listStatus(place))
    return found


def test_only_touched_buckets_are_rewritten(spark, scratch):
    first = [change(i + 1, i) for i in range(400)]
    assert merge_changes(spark, frame(spark, first), scratch, KEYS, 16) == list(range(16))
    before = files(spark, scratch)
    later = [change(1000, 3), change(1001, 5, "d"), change(1002, 999)]
    touched = merge_changes(spark, frame(spark, later), scratch, KEYS, 16)
    where = frame(spark, later).select(bucket_of(KEYS, 16).alias("b")).distinct()
    assert touched == sorted(r.b for r in where.collect()) and len(touched) <= 3
    after = files(spark, scratch)
    for b in before:
        assert (before[b] == after[b]) == (int(b.split("=")[1]) not in touched)
    assert rows(read_merged(spark, scratch, KEYS)) == rows(cdc.current_state(frame(spark, first + later), KEYS))


def test_late_older_change_does_not_bring_a_deleted_key_back(spark, scratch):
    merge_changes(spark, frame(spark, [change(5, 1), change(9, 1, "d"), change(7, 2)]), scratch, KEYS, 4)
    merge_changes(spark, frame(spark, [change(8, 1)]), scratch, KEYS, 4)
    assert [r.employee_id for r in read_merged(spark, scratch, KEYS).collect()] == [2]
    merge_changes(spark, frame(spark, [change(10, 1)]), scratch, KEYS, 4)
    assert sorted(r.employee_id for r in read_merged(spark, scratch, KEYS).collect()) == [1, 2]


def test_truncate_in_one_merge_holds_for_rows_of_another(spark, scratch):
    merge_changes(spark, frame(spark, [change(6, None, "t"), change(9, 3)]), scratch, KEYS, 4)
    merge_changes(spark, frame(spark, [change(5, 1), change(7, 2)]), scratch, KEYS, 4)
    assert sorted(r.employee_id for r in read_merged(spark, scratch, KEYS).collect()) == [2, 3]


def test_no_changes_rewrite_nothing_and_a_rerun_changes_no_row(spark, scratch):
    some = frame(spark, [change(i + 1, i % 7) for i in range(30)])
    merge_changes(spark, some, scratch, KEYS, 4)
    before, had = files(spark, scratch), rows(read_merged(spark, scratch, KEYS))
    assert merge_changes(spark, some.limit(0), scratch, KEYS, 4) == []
    assert files(spark, scratch) == before
    merge_changes(spark, some, scratch, KEYS, 4)
    assert rows(read_merged(spark, scratch, KEYS)) == had


def test_a_merge_that_died_between_buckets_is_completed_by_a_rerun(spark, scratch, monkeypatch):
    from perkflow.sinks import merge

    first = frame(spark, [change(i + 1, i) for i in range(60)])
    merge_changes(spark, first, scratch, KEYS, 8)
    second = frame(spark, [change(100 + i, i) for i in range(60)])
    real, calls = merge.swap_in, []

    def dies(spark_, staged, target):
        calls.append(target)
        if len(calls) == 4:
            raise RuntimeError("executor lost")
        real(spark_, staged, target)

    monkeypatch.setattr(merge, "swap_in", dies)
    try:
        merge_changes(spark, second, scratch, KEYS, 8)
        raise AssertionError("should have died")
    except RuntimeError:
        pass
    monkeypatch.setattr(merge, "swap_in", real)
    merge_changes(spark, second, scratch, KEYS, 8)
    assert rows(read_merged(spark, scratch, KEYS)) == rows(cdc.current_state(second, KEYS))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from("ucudt")), min_size=1, max_size=25), st.randoms())
def test_any_order_of_merges_equals_the_current_state(spark, drawn, rnd: random.Random):
    log = [change(i + 1, k, op) for i, (k, op) in enumerate(drawn)]
    shuffled = rnd.sample(log, len(log))
    root, cut = scratch_path(spark, "merge"), len(log) // 2
    merge_changes(spark, frame(spark, shuffled[:cut]), root, KEYS, 3)
    merge_changes(spark, frame(spark, shuffled[cut:]), root, KEYS, 3)
    want = rows(cdc.current_state(frame(spark, log), KEYS))
    assert rows(read_merged(spark, root, KEYS)) == want, json.dumps(drawn)
