import itertools
import random

import pytest

from retail_stream.operators import alerts

DAY = 1_704_067_200_000


def events(spark, *rows):
    """Rows of (device, account, event, second) and optionally the item."""
    data = [(m, u, e, *(i or ["i"]), DAY + s * 1000) for m, u, e, s, *i in rows]
    frame = spark.createDataFrame(data, "mid string, uid string, evid string, itemid string, ts bigint")
    return alerts.with_event_time(frame)


def coupons(accounts, second=0):
    return [("m", a, "coupon", second) for a in accounts]


@pytest.mark.parametrize(
    "rows, fires",
    [
        (coupons("abc"), True),
        (coupons("ab"), False),
        (coupons("abc") + [("m", "d", "clickItem", 1)], False),
        (coupons("aaa"), False),
        (coupons("abc") + [("n", "d", "clickItem", 1)], True),
        (coupons("ab") + coupons("c", 29), True),
        (coupons("ab") + coupons("c", 30), False),
    ],
)
def test_rule(spark, rows, fires):
    assert (alerts.coupon_alerts(events(spark, *rows)).count() > 0) == fires


def test_record(spark):
    rows = [("m", a, "coupon", 0, i) for a, i in zip("cab", ["2", "1", None])]
    got = alerts.coupon_alerts(events(spark, *rows, ("m", "z", "addCart", 0, "9"))).collect()
    assert len(got) == 10
    assert {(tuple(r.uids), tuple(r.itemIds), tuple(r.events)) for r in got} == {
        (("a", "b", "c"), ("1", "2"), ("addCart", "coupon"))
    }
    assert sorted(r.ts for r in got) == [DAY + 3000 * k for k in range(1, 11)]


@pytest.mark.parametrize("length, slide", [(30, 3), (10, 4), (6, 6), (7, 5)])
def test_against_brute_force(spark, length, slide):
    rng = random.Random(length)
    rows = [
        (rng.choice("mn"), rng.choice("abcdef"), rng.choice(["coupon", "coupon", "addCart", "clickItem"]),
         rng.randrange(90), rng.choice("123"))
        for _ in range(60)
    ]
    expected = set()
    first = -(length // slide + 1) * slide
    # Windows are aligned to the epoch, and the day may start inside a slide.
    shift = -(DAY // 1000) % slide
    for device, start in itertools.product("mn", range(first + shift, 100, slide)):
        inside = [r for r in rows if r[0] == device and start <= r[3] < start + length]
        claims = {r[1] for r in inside if r[2] == "coupon"}
        if len(claims) >= 2 and not any(r[2] == "clickItem" for r in inside):
            items = {r[4] for r in inside if r[2] == "coupon"}
            expected.add(
                (device, DAY + (start + length) * 1000, tuple(sorted(claims)), tuple(sorted(items)),
                 tuple(sorted({r[2] for r in inside})))
            )
    found = alerts.coupon_alerts(
        events(spark, *rows), f"{length} seconds", f"{slide} seconds", min_accounts=2
    )
    got = [(r.mid, r.ts, tuple(r.uids), tuple(r.itemIds), tuple(r.events)) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
