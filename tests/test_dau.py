from retail_stream import schemas
from retail_stream.operators import counts, dedup

ROW = {
    "uid": "u", "appid": "a", "area": "x", "os": "ios", "ch": "c", "type": "startup", "vs": "1",
    "log_hour": "00",
}


def logs(spark, *rows):
    """Rows of (log_date, mid, ts) and optional further fields."""
    data = []
    for date, mid, ts, *more in rows:
        full = {**ROW, "log_date": date, "mid": mid, "ts": ts, **(more[0] if more else {})}
        data.append(tuple(full[c] for c in schemas.STARTUP_COLUMNS))
    columns = ", ".join(f"{c} {'bigint' if c == 'ts' else 'string'}" for c in schemas.STARTUP_COLUMNS)
    return spark.createDataFrame(data, columns)


def keys(frame):
    return sorted((r.log_date, r.mid, r.ts) for r in frame.collect())


def test_first_start_of_a_batch(spark):
    rows = logs(spark, *[("d1", "m", t) for t in (20, 10, 30)], ("d2", "m", 50))
    assert keys(dedup.first_starts(rows)) == [("d1", "m", 10), ("d2", "m", 50)]


def test_next_batch_adds_nothing_for_a_seen_device(spark):
    first = dedup.first_starts(logs(spark, ("d", "m", 10)))
    second = dedup.first_starts(logs(spark, ("d", "m", 40), ("d", "n", 41)))
    assert keys(dedup.drop_seen(second, first)) == [("d", "n", 41)]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("d", "m", 10, {"uid": u, "ch": c}) for u in "21" for c in "ba"]
    for order in (rows, rows[::-1]):
        kept = dedup.first_starts(logs(spark, *order)).collect()
        assert [(r.uid, r.ch) for r in kept] == [("1", "a")]


def test_top_n(spark):
    rows = logs(spark, *[("d", "m", t) for t in range(9, 0, -1)], ("d", "n", 1))
    got = keys(dedup.first_starts(rows, 3))
    assert got == [("d", "m", 1), ("d", "m", 2), ("d", "m", 3), ("d", "n", 1)]


def test_top_n_in_salted_parts_gives_the_same(spark, settings):
    rows = logs(spark, *[("d", f"m{t % 2}", t) for t in range(200)])
    plain = keys(dedup.first_starts(rows, 50))
    settings(spark__sql__optimizer__windowGroupLimitThreshold="10")
    assert keys(dedup.first_starts(rows, 50)) == plain and len(plain) == 100


def table(spark):
    return logs(
        spark,
        ("2023-12-31", "a", 1, {"log_hour": "23"}),
        ("2024-01-01", "a", 2, {"log_hour": "13"}),
        ("2024-01-01", "b", 3, {"log_hour": "00"}),
        ("2024-01-01", "c", 4, {"log_hour": "00"}),
        ("2024-01-02", "d", 5, {"log_hour": "07"}),
    )


def test_total(spark):
    assert counts.dau_total(table(spark), "2024-01-01").first().total == 3
    assert counts.dau_total(table(spark), "1999-01-01").first().total == 0


def test_hours_are_sparse(spark):
    got = {r.log_hour: r.ct for r in counts.dau_hourly(table(spark), "2024-01-01").collect()}
    assert got == {"00": 2, "13": 1}
    assert counts.dau_hour_map(table(spark), "2024-01-01").first().hours == got
    assert counts.dau_hour_map(table(spark), "1999-01-01").first().hours == {}


def test_new_devices(spark):
    assert counts.new_devices(table(spark), "2024-01-01").first().new_mids == 2
    assert counts.new_devices(table(spark), "1999-01-01").first().new_mids == 0


def test_realtime_total(spark):
    assert counts.realtime_total(table(spark), "2024-01-01").first().json == (
        '[{"id":"dau","name":"新增日活","value":3},{"id":"new_mid","name":"新增设备","value":2}]'
    )
    assert '"value":0' in counts.realtime_total(table(spark), "1999-01-01").first().json


def test_realtime_hours(spark):
    assert counts.realtime_hours(table(spark), "dau", "2024-01-01").first().json == (
        '{"yesterday":{"23":1},"today":{"00":2,"13":1}}'
    )
    assert counts.realtime_hours(table(spark), "dau", "2023-12-31").first().json == (
        '{"yesterday":{},"today":{"23":1}}'
    )


def test_unknown_metric(spark):
    import pytest

    with pytest.raises(ValueError):
        counts.realtime_hours(table(spark), "gmv", "2024-01-01")
