"""Window metrics on random timestamps against a plain-Python model."""

import datetime as dt
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from memberlens.operators import metrics as M

AS_OF = dt.date(2020, 3, 15)
BASE = dt.datetime(2020, 2, 20)
SECONDS = st.integers(0, 30 * 86400)


def _members(spark, secs):
    rows = [(i, "x", 1, 1, "x", i, BASE + dt.timedelta(seconds=s)) for i, s in enumerate(secs)]
    return spark.createDataFrame(rows, "id long, phone string, sex int, member_channel int, "
                                       "mp_open_id string, address_default_id long, create_time timestamp")


@settings(max_examples=6, deadline=None)
@given(st.lists(SECONDS, max_size=40))
def test_wow_matches_model(spark, secs):
    m = _members(spark, secs)
    days = [(BASE + dt.timedelta(seconds=s)).date() for s in secs]
    lo = AS_OF - dt.timedelta(days=14)
    expect = Counter(d.isoformat() for d in days if lo <= d < AS_OF)
    got = {r.day: r.regCount for r in M.wow_reg(m, AS_OF.isoformat()).collect()}
    assert got == dict(expect)
    offsets = Counter((AS_OF - d).days for d in days if lo <= d < AS_OF)
    cmp = {r.dayOffset: (r.thisWeek, r.lastWeek) for r in M.wow_compare(m, "id", AS_OF.isoformat()).collect()}
    assert cmp == {k: (offsets.get(k, 0), offsets.get(k + 7, 0)) for k in range(1, 8)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(SECONDS, st.integers(1, 3), st.integers(1, 3)), max_size=40))
def test_remind_free_matches_model(spark, claims):
    rows = [(i, i % 5, cid, ch, BASE + dt.timedelta(seconds=s)) for i, (s, cid, ch) in enumerate(claims)]
    cm = spark.createDataFrame(rows, "id long, member_id long, coupon_id long, coupon_channel long, "
                                     "create_time timestamp")
    lo = dt.datetime.combine(AS_OF - dt.timedelta(days=7), dt.time())
    expect = Counter(r[4].date().isoformat() for r in rows if r[2] == 1 and r[3] == 2 and r[4] >= lo)
    got = {r.day: r.freeCount for r in M.remind_free(cm, AS_OF.isoformat()).collect()}
    assert got == dict(expect)


@settings(max_examples=5, deadline=None)
@given(st.lists(SECONDS, min_size=1, max_size=30), st.lists(st.tuples(SECONDS, st.integers(1, 999)), max_size=30))
def test_growth_line_matches_model(spark, msecs, orders):
    m = _members(spark, msecs)
    o = spark.createDataFrame([(i, 0, 2, float(p), float(p) - 5, BASE + dt.timedelta(seconds=s))
                               for i, (s, p) in enumerate(orders)],
                              "order_id long, member_id long, order_status int, origin_price double, "
                              "pay_price double, create_time timestamp")
    lo = dt.datetime.combine(AS_OF - dt.timedelta(days=7), dt.time())
    reg, max_id, max_o, gmv = Counter(), {}, {}, Counter()
    for i, s in enumerate(msecs):
        t = BASE + dt.timedelta(seconds=s)
        if t >= lo:
            d = t.date().isoformat()
            reg[d] += 1
            max_id[d] = max(max_id.get(d, -1), i)
    for i, (s, p) in enumerate(orders):
        t = BASE + dt.timedelta(seconds=s)
        if t >= lo:
            d = t.date().isoformat()
            max_o[d] = max(max_o.get(d, -1), i)
            gmv[d] += p
    expect = [(d, reg[d], max_id[d], max_o[d], float(gmv[d])) for d in sorted(set(reg) & set(max_o))]
    got = [tuple(r) for r in M.growth_line(m, o, AS_OF.isoformat()).collect()]
    assert got == expect
