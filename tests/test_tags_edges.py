"""Edge cases of the tag table: fan-out, free coupons, feedback, grain."""

import datetime as dt

from memberlens.operators import tags as TG

D = dt.datetime.fromisoformat


def shop(spark, orders=(), lines=(), coupons=(), claims=(), deliveries=(), feedback=(), members=None):
    return {
        "t_member": spark.createDataFrame(members or [(7, "13800000007", 1, 2, "wx7", 7, D("2020-01-01"))],
                                          "id long, phone string, sex int, member_channel int, "
                                          "mp_open_id string, address_default_id long, create_time timestamp"),
        "t_order": spark.createDataFrame(list(orders), "order_id long, member_id long, order_status int, "
                                         "origin_price double, pay_price double, create_time timestamp"),
        "t_order_commodity": spark.createDataFrame(list(lines), "order_id long, commodity_id long"),
        "t_coupon": spark.createDataFrame(list(coupons), "id long, coupon_price double"),
        "t_coupon_member": spark.createDataFrame(list(claims), "id long, member_id long, coupon_id long, "
                                                 "coupon_channel long, create_time timestamp"),
        "t_delivery": spark.createDataFrame(list(deliveries), "member_id long, pick_time timestamp, "
                                            "arrive_time timestamp"),
        "t_feedback": spark.createDataFrame(list(feedback), "id long, member_id long, feedback_type long"),
    }


def test_line_fan_out_vs_order_grain(spark):
    t = shop(spark, orders=[(1, 7, 2, 90.0, 80.0, D("2020-01-02")), (2, 7, 2, 50.0, 40.0, D("2020-01-03"))],
             lines=[(1, 5), (1, 6), (2, 5)])
    line = TG.tag_order_behavior(t["t_order"], t["t_order_commodity"]).first()
    order = TG.tag_order_behavior_by_order(t["t_order"], t["t_order_commodity"]).first()
    assert (line.orderCount, line.orderMoney) == (3, 200.0)
    assert (order.orderCount, order.orderMoney) == (2, 120.0)
    assert line.favGoods == order.favGoods == [5, 6]
    assert line.orderTime == "2020-01-03"


def test_order_without_lines(spark):
    t = shop(spark, orders=[(1, 7, 2, 9.0, 8.0, D("2020-01-02"))])
    r = TG.tag_order_behavior(t["t_order"], t["t_order_commodity"]).first()
    assert (r.orderCount, r.favGoods, r.orderMoney) == (1, [], 8.0)


def test_two_free_coupons(spark):
    t = shop(spark, claims=[(1, 7, 1, 2, D("2020-01-02 10:00:00")), (2, 7, 1, 2, D("2020-01-05 10:00:00")),
                            (3, 7, 4, 2, D("2020-01-05 11:00:00")), (4, 7, 4, 1, D("2020-01-03 11:00:00"))],
             coupons=[(4, 10.0)])
    wide = TG.user_tag(t).collect()
    assert sorted(r.freeCouponTime for r in wide) == ["2020-01-02", "2020-01-05"]
    one = TG.user_tag_member(t).collect()
    assert len(one) == 1 and one[0].freeCouponTime == "2020-01-05"
    assert one[0].couponTimes == ["2020-01-03", "2020-01-05"]
    assert one[0].chargeMoney == 5.0          # only the channel-2 paid coupon: 10 / 2
    assert wide[0].chargeMoney == 5.0 and wide[0].couponTimes == ["2020-01-03", "2020-01-05"]


def test_member_without_anything_keeps_one_row(spark):
    t = shop(spark)
    rows = TG.user_tag(t).collect()
    assert len(rows) == 1 and rows[0].orderCount is None and rows[0].freeCouponTime is None
    assert TG.user_tag_member(t).count() == 1


def test_latest_feedback_and_over_time(spark):
    t = shop(spark, feedback=[(5, 7, 1), (9, 7, 3)],
             deliveries=[(7, D("2020-01-01 10:00:00"), D("2020-01-01 10:20:00")),
                         (7, D("2020-01-02 10:00:00"), D("2020-01-02 10:45:00"))])
    assert TG.tag_feedback(t["t_feedback"]).first().feedback == 3
    assert TG.tag_over_time(t["t_delivery"]).first().overTime == 45 * 60


def test_coupon_times_keeps_duplicates_sorted(spark):
    t = shop(spark, claims=[(1, 7, 3, 2, D("2020-01-05 10:00:00")), (2, 7, 3, 2, D("2020-01-02 10:00:00")),
                            (3, 7, 4, 2, D("2020-01-05 12:00:00"))])
    r = TG.tag_coupon_times(t["t_coupon_member"]).first()
    assert r.couponTimes == ["2020-01-02", "2020-01-05", "2020-01-05"]


def test_one_row_per_member_on_fixture(spark):
    from memberlens.plans.registry import shop_tables
    from tests.conftest import SF_SMALL
    t = shop_tables(spark, SF_SMALL)
    tags = TG.user_tag_member(t)
    assert tags.count() == t["t_member"].count() == tags.select("memberId").distinct().count()


def test_line_grain_equals_order_grain_when_one_line_per_order(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 19), st.integers(1, 500)),
                    min_size=1, max_size=12))
    def check(rows):
        orders = [(i, m, 2, float(p), float(p) - 5.0, D("2020-01-01")) for i, (m, _, p) in enumerate(rows)]
        lines = [(i, g) for i, (_, g, _) in enumerate(rows)]
        t = shop(spark, orders=orders, lines=lines)
        a = sorted(map(tuple, TG.tag_order_behavior(t["t_order"], t["t_order_commodity"]).collect()))
        b = sorted(map(tuple, TG.tag_order_behavior_by_order(t["t_order"], t["t_order_commodity"]).collect()))
        assert a == b

    check()


def test_skewed_member_is_exact(spark):
    # One member owns most claims and orders: results must be whole and exact.
    hot = 7
    claims = [(i, hot, 1 + (i % 3 == 0), 2, D(f"2020-01-{1 + i % 9:02d} 10:00:00")) for i in range(3000)]
    claims += [(10000 + i, 8, 5, 2, D("2020-01-02 10:00:00")) for i in range(3)]
    orders = [(i, hot, 2, 10.0, 5.0, D("2020-01-03")) for i in range(2000)] + [(9999, 8, 2, 1.0, 1.0, D("2020-01-01"))]
    members = [(7, "1", 1, 1, "x", 7, D("2020-01-01")), (8, "2", 1, 1, "x", 8, D("2020-01-01"))]
    t = shop(spark, members=members, claims=claims, orders=orders, coupons=[(2, 4.0), (5, 2.0)])
    rows = {r.memberId: r for r in TG.user_tag_member(t).collect()}
    paid = [c for c in claims if c[1] == hot and c[2] != 1]
    days = sorted(c[4].strftime("%Y-%m-%d") for c in paid)
    assert rows[hot].couponTimes == sorted(set(days))
    assert rows[hot].couponCounts == [days.count(d) for d in sorted(set(days))]
    assert rows[hot].orderCount == 2000 and rows[hot].orderMoney == 10000.0
    assert rows[hot].chargeMoney == 2.0 * len(paid)        # price 4.0 / 2 per paid claim
    assert rows[8].couponTimes == ["2020-01-02"] and rows[8].couponCounts == [3]
    fanned = [r for r in TG.user_tag(t).collect() if r.memberId == hot]
    assert len(fanned) == sum(1 for c in claims if c[1] == hot and c[2] == 1)


def test_claim_without_time(spark):
    t = shop(spark, claims=[(1, 7, 4, 2, None), (2, 7, 4, 2, D("2020-01-03 10:00:00")),
                            (3, 7, 1, 2, None)],
             coupons=[(4, 10.0)])
    r = TG.tag_coupon_times(t["t_coupon_member"]).first()
    assert r.couponTimes == ["2020-01-03"]
    one = TG.user_tag_member(t).first()
    assert one.couponTimes == ["2020-01-03"] and one.freeCouponTime is None
    wide = TG.user_tag(t).collect()
    assert len(wide) == 1 and wide[0].freeCouponTime is None   # the free claim row, no day
    only_null = shop(spark, claims=[(1, 7, 4, 2, None)], coupons=[(4, 10.0)])
    assert TG.tag_coupon_times(only_null["t_coupon_member"]).first().couponTimes == []


def test_fan_out_expansion_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(TG, "FANOUT_CHUNK", 7)
    claims = [(i, 7, 1, 2, D("2020-01-02 10:00:00")) for i in range(30)]     # 30 on one day
    claims += [(100 + i, 7, 1, 2, D("2020-01-03 10:00:00")) for i in range(7)]  # exactly one chunk
    t = shop(spark, claims=claims)
    days = [r.freeCouponTime for r in TG.user_tag(t).collect()]
    assert sorted(days) == ["2020-01-02"] * 30 + ["2020-01-03"] * 7
    nobody = shop(spark)
    assert [r.freeCouponTime for r in TG.user_tag(nobody).collect()] == [None]
