"""Edge cases of the dashboard metrics (FIXTURES.md section c)."""

import datetime as dt

from memberlens.operators import metrics as M

MEMBER_COLS = ("id long, phone string, sex int, member_channel int, mp_open_id string, "
               "address_default_id long, create_time timestamp")
ORDER_COLS = ("order_id long, member_id long, order_status int, origin_price double, "
              "pay_price double, create_time timestamp")
CM_COLS = "id long, member_id long, coupon_id long, coupon_channel long, create_time timestamp"


def ts(s):
    return dt.datetime.fromisoformat(s)


def members(spark, rows):
    return spark.createDataFrame(rows, MEMBER_COLS)


def test_sentinel_null_vs_sql_null(spark):
    m = members(spark, [(1, "null", 1, 1, "null", 1, ts("2020-01-01")),
                        (2, "138", 1, 1, None, 1, ts("2020-01-01")),
                        (3, "138", 1, 1, "wx1", 1, ts("2020-01-01"))])
    r = M.member_mp_sub(m).first()
    assert (r.subCount, r.unSubCount) == (1, 1)


def test_member_heat_counts(spark):
    m = members(spark, [(1, "null", 1, 1, "x", 1, ts("2020-01-01")),
                        (2, "138", 2, 1, "x", 1, ts("2020-01-01"))])
    o = spark.createDataFrame([(10, 1, 2, 5.0, 0.0, ts("2020-01-01")),
                               (11, 2, 1, 5.0, 0.0, ts("2020-01-01")),
                               (12, 2, 3, 5.0, 0.0, ts("2020-01-02"))], ORDER_COLS)
    cm = spark.createDataFrame([(1, 1, 1, 1, ts("2020-01-01")), (2, 1, 2, 2, ts("2020-01-01"))], CM_COLS)
    r = M.member_heat(m, o, cm).first().asDict()
    assert r == {"coupon": 1, "reg": 1, "complete": 1, "order": 1, "orderAgain": 1}


def test_funnel(spark):
    o = spark.createDataFrame([
        (1, 1, 2, 1.0, 1.0, ts("2020-01-01")), (2, 1, 2, 1.0, 1.0, ts("2020-01-01")),
        (3, 2, 2, 1.0, 1.0, ts("2020-01-01")),
        (4, 3, 1, 1.0, 1.0, ts("2020-01-01")), (5, 3, 1, 1.0, 1.0, ts("2020-01-01"))], ORDER_COLS)
    cm = spark.createDataFrame([(1, 1, 5, 1, ts("2020-01-01")), (2, 3, 5, 1, ts("2020-01-01"))], CM_COLS)
    r = M.conversion_funnel(o, cm).first().asDict()
    assert r == {"present": 1000, "click": 800, "addCart": 600, "order": 2, "orderAgain": 1,
                 "chargeCoupon": 1}


def test_growth_inner_join_drops_day_without_orders(spark):
    m = members(spark, [(1, "x", 1, 1, "x", 1, ts("2020-01-05 10:00:00")),
                        (2, "x", 1, 1, "x", 1, ts("2020-01-06 10:00:00"))])
    o = spark.createDataFrame([(7, 1, 2, 10.0, 5.0, ts("2020-01-05"))], ORDER_COLS)
    rows = M.growth_line(m, o, "2020-01-08").collect()
    assert [r.day for r in rows] == ["2020-01-05"]
    assert rows[0].gmv == 10.0 and rows[0].memberCount == 1 and rows[0].orderCount == 7


def test_gmv_before_empty_history_is_zero(spark):
    o = spark.createDataFrame([(7, 1, 2, 10.0, 5.0, ts("2020-01-05"))], ORDER_COLS)
    assert M.gmv_before(o, "2020-01-08").first().totalGmv == 0.0


def test_gmv_cumulative_running_total(spark):
    m = members(spark, [(1, "x", 1, 1, "x", 1, ts("2020-01-05 10:00:00")),
                        (2, "x", 1, 1, "x", 1, ts("2020-01-06 10:00:00"))])
    o = spark.createDataFrame([(1, 1, 2, 100.0, 0.0, ts("2019-12-01")),
                               (2, 1, 2, 0.1, 0.0, ts("2020-01-05")),
                               (3, 1, 2, 0.2, 0.0, ts("2020-01-06"))], ORDER_COLS)
    rows = M.gmv_cumulative(m, o, "2020-01-08").collect()
    assert [(r.day, r.totalGmv) for r in rows] == [("2020-01-05", 100.1), ("2020-01-06", 100.3)]
    assert [(r.totalMembers, r.totalOrders) for r in rows] == [(1, 2), (2, 3)]


def test_wow_window_edges(spark):
    # as_of - 14 is in, just before as_of is in, as_of itself is out.
    m = members(spark, [(1, "x", 1, 1, "x", 1, ts("2020-01-01 00:00:00")),
                        (2, "x", 1, 1, "x", 1, ts("2020-01-14 23:59:59")),
                        (3, "x", 1, 1, "x", 1, ts("2020-01-15 00:00:00"))])
    days = {r.day: r.regCount for r in M.wow_reg(m, "2020-01-15").collect()}
    assert days == {"2020-01-01": 1, "2020-01-14": 1}
    cmp = {r.dayOffset: (r.thisWeek, r.lastWeek) for r in M.wow_compare(m, "id", "2020-01-15").collect()}
    assert cmp[1] == (1, 0) and cmp[7] == (0, 1) and len(cmp) == 7
    assert sum(a + b for a, b in cmp.values()) == 2


def test_remind_expiry(spark):
    cm = spark.createDataFrame([
        (1, 1, 1, 2, ts("2020-01-06 09:00:00")),   # free, claimed as_of-9 -> lapses in 1 day
        (2, 2, 7, 2, ts("2020-01-04 09:00:00")),   # paid, as_of-11 -> 3 days
        (3, 3, 7, 2, ts("2020-01-05 09:00:00")),   # paid, as_of-10 -> 2 days: not a paid offset
    ], CM_COLS)
    got = {(r.kind, r.daysLeft): r.memberCount for r in M.remind_expiry(cm, "2020-01-15").collect()}
    assert got == {("free", 1): 1, ("paid", 3): 1}


def test_member_heat_approx_option(spark):
    from tests.conftest import SF_SMALL
    from memberlens.sources import fixtures as FX
    t = FX.load(spark, SF_SMALL, "t_member", "t_order", "t_coupon_member")
    exact = M.member_heat(t["t_member"], t["t_order"], t["t_coupon_member"]).first()
    approx = M.member_heat(t["t_member"], t["t_order"], t["t_coupon_member"], approx=True).first()
    assert abs(approx.coupon - exact.coupon) <= max(2, 0.05 * exact.coupon)
    assert approx.reg == exact.reg and approx.orderAgain == exact.orderAgain
