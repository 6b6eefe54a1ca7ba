from ferrolex.operators import quality
from ferrolex.operators.quality import control_limits, findings, keep_states, kept_states, load_metrics, load_states, merge_states, metrics

PROFILE = [("x", 0.5, 0.0, 10.0, 5.0, None), ("t", 0.1, None, None, None, "^a+$"), ("gone", 0.1, None, None, None, None)]


def tables(spark, rows):
    p = spark.createDataFrame(PROFILE, "column_name string, null_limit double, low_value double, high_value double, mid_value double, shape string")
    return spark.createDataFrame(rows, "load_id bigint, x double, t string, value string, n bigint"), p


def test_findings(spark):
    rows = [(1, float(i % 10), "aa", "v", 1) for i in range(40)]
    rows += [(2, 7.0, "b", None, 1) for _ in range(30)]
    rows += [(3, None, None, None, 1) for _ in range(30)]
    rows += [(4, 1.0, "a", None, 1)] * 19
    rows += [(None, 100.0 + i, "a", None, 1) for i in range(30)]
    found = {tuple(r) for r in findings(*tables(spark, rows)).collect()}
    assert found == {(2, "x", "shift"), (2, "x", "repeat"), (2, "t", "shape"), (3, "x", "nulls"), (3, "t", "nulls"), (None, "x", "range"), (None, "x", "shift")}


def test_nan_is_outside_and_empty_tables(spark):
    found = {tuple(r)[1:] for r in findings(*tables(spark, [(1, float("nan"), "a", None, 1)] * 20)).collect()}
    assert found == {("x", "range"), ("x", "shift"), ("x", "repeat")}
    assert findings(*tables(spark, [])).count() == 0


def test_states_merge_and_are_kept(spark, tmp_path):
    rows = [(i % 3, float(i % 7), "a" * (i % 4), None, 1) for i in range(200)]
    df, p = tables(spark, rows)
    a, b = tables(spark, rows[:77])[0], tables(spark, rows[77:])[0]
    whole = sorted(map(str, load_metrics(load_states(df, p)).collect()))
    assert whole == sorted(map(str, load_metrics(merge_states(load_states(a, p), load_states(b, p))).collect()))
    for part in (a, b):
        keep_states(load_states(part, p), str(tmp_path / "states"))
    assert whole == sorted(map(str, load_metrics(kept_states(spark, str(tmp_path / "states"))).collect()))
    assert {r.n_distinct for r in load_metrics(load_states(df, p)).where("column_name = 'x'").collect()} == {7}


def test_the_state_has_a_fixed_size(spark):
    df, p = tables(spark, [(1, float(i), "a", None, 1) for i in range(5000)])
    few, many = load_states(df.limit(2000), p), load_states(df, p)
    assert many.count() == 2 and {len(r.seen) for r in many.collect() if r.is_number} == {len(r.seen) for r in few.collect() if r.is_number}


def test_frequent_values_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 2)
    monkeypatch.setattr(quality, "COUNTS", quality.COUNTS[:7])
    rows = [(1, float(i), "a", None, 1) for i in range(100)]  # both buckets are large, no value is
    rows += [(2, 4.0 if i < 31 else float(i), "a", None, 1) for i in range(100)] + [(3, 4.0 if i < 30 else float(i + 100), "a", None, 1) for i in range(100)]
    rows += [(None, -0.0 if i % 2 else 0.0, "a", None, 1) for i in range(40)]
    got = {r.load_id: r.top_share for r in metrics(*tables(spark, rows)).where("column_name = 'x'").collect()}
    assert got == {1: None, 2: 0.31, 3: None, None: 1.0}


def test_control_limits_look_back_only(spark, monkeypatch):
    monkeypatch.setattr(quality, "SPANS", 3)
    rows = [(load, float(i % 9) if (i + load) % 12 else None, "a", None, 1) for load in range(20) for i in range(48)]
    rows += [(99, None if i % 2 else 1.0, "a", None, 1) for i in range(50)] + [(3_000, 1.0, "a", None, 1)] * 50
    found = control_limits(load_metrics(load_states(*tables(spark, rows)))).collect()
    assert {(r.load_id, r.metric) for r in found if r.column_name == "x" and r.metric == "null_share"} == {(99, "null_share")}
    first = [(99, None if i % 2 else 1.0, "a", None, 1) for i in range(50)]
    assert control_limits(load_metrics(load_states(*tables(spark, first)))).count() == 0


def test_many_buckets_in_doubt_are_joined_by_a_shuffle(spark, monkeypatch):
    rows = [(load, 4.0 if i < 40 else float(i), "a", None, 1) for load in range(5) for i in range(100)]
    few = {tuple(r) for r in findings(*tables(spark, rows)).collect()}
    monkeypatch.setattr(quality, "MAX_DOUBT", 0)
    assert few == {tuple(r) for r in findings(*tables(spark, rows)).collect()} and {(k, "x", "repeat") for k in range(5)} <= few
