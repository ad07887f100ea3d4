"""Independent SQL for every registered query, as DuckDB runs it.

Written by hand from the operator semantics (not generated from the Spark
plans), over the same fixture views, so the comparison checks the Spark
code against a second implementation. Anchor dates are the fixture's
fixed values: members/orders as of 2001-08-01, coupons as of 2024-01-31.
"""

from __future__ import annotations

from memberlens.plans import registry as _R
from memberlens.sources.fixtures import with_views as W

DAY = "strftime({c}, '%Y-%m-%d')"


def day(c: str) -> str:
    return DAY.format(c=c)


def money(c: str) -> str:
    return f"cast(sum(cast({c} as decimal(18,2))) as double)"


ORACLE: dict[str, str] = {}

# ----------------------------------------------------------------- metrics

ORACLE["member_sex"] = W("t_member") + """
select sex as memberSex, count(id) as sexCount from t_member group by sex"""

ORACLE["member_channel"] = W("t_member") + """
select member_channel as memberChannel, count(id) as channelCount from t_member group by member_channel"""

ORACLE["member_mp_sub"] = W("t_member") + """
select count(case when mp_open_id <> 'null' then 1 end) as subCount,
       count(case when mp_open_id = 'null' then 1 end) as unSubCount
from t_member"""

_HEAT = """
select c.coupon, r.reg, r.complete, o."order", o.orderAgain from
  (select count(distinct member_id) as coupon from t_coupon_member) c,
  (select count(case when phone = 'null' then 1 end) as reg,
          count(case when phone <> 'null' then 1 end) as complete from t_member) r,
  (select count(case when n = 1 then 1 end) as "order",
          count(case when n >= 2 then 1 end) as orderAgain
   from (select member_id, count(*) as n from t_order group by member_id) t) o"""

ORACLE["member_heat"] = W("t_member", "t_order", "t_coupon_member") + _HEAT

ORACLE["member_overview"] = W("t_member", "t_order", "t_coupon_member") + f"""
, heat as ({_HEAT})
select 'sex' as metric, cast(sex as varchar) as key, count(id) as value from t_member group by sex
union all
select 'channel', cast(member_channel as varchar), count(id) from t_member group by member_channel
union all
select 'subCount', null, count(case when mp_open_id <> 'null' then 1 end) from t_member
union all
select 'unSubCount', null, count(case when mp_open_id = 'null' then 1 end) from t_member
union all select 'coupon', null, coupon from heat
union all select 'reg', null, reg from heat
union all select 'complete', null, complete from heat
union all select 'order', null, "order" from heat
union all select 'orderAgain', null, orderAgain from heat"""

ORACLE["member_overview_document"] = W("t_member", "t_order", "t_coupon_member") + f"""
, heat as ({_HEAT})
, sx as (select sex, count(id) as n from t_member group by sex)
, ch as (select member_channel as c, count(id) as n from t_member group by member_channel)
, sub as (select count(case when mp_open_id <> 'null' then 1 end) as subCount,
                 count(case when mp_open_id = 'null' then 1 end) as unSubCount from t_member)
select to_json({{
  'memberSexes': (select list({{'memberSex': sex, 'sexCount': n}} order by sex) from sx),
  'memberChannels': (select list({{'memberChannel': c, 'channelCount': n}} order by c) from ch),
  'memberMpSubs': (select [{{'subCount': subCount, 'unSubCount': unSubCount}}] from sub),
  'memberHeat': (select {{'reg': reg, 'complete': complete, 'order': "order",
                         'orderAgain': orderAgain, 'coupon': coupon}} from heat)
}})::varchar as document"""

ORACLE["conversion_funnel"] = W("t_order", "t_coupon_member") + """
, paid as (select member_id, count(*) as n from t_order where order_status = 2 group by member_id)
, charged as (select distinct member_id from t_coupon_member where coupon_channel = 1)
select cast(1000 as bigint) as present, cast(800 as bigint) as click, cast(600 as bigint) as addCart,
       (select count(*) from paid) as "order",
       (select count(*) from paid where n > 1) as orderAgain,
       (select count(*) from paid p join charged c on p.member_id = c.member_id where p.n > 1) as chargeCoupon"""

_GROWTH_DAILY = f"""
, m as (select {day('create_time')} as day, count(id) as regCount, max(id) as memberCount
        from t_member where create_time >= timestamp '2001-07-25 00:00:00' group by 1)
, o as (select {day('create_time')} as day, max(order_id) as orderCount,
               sum(cast(origin_price as decimal(18,2))) as gmv_exact
        from t_order where create_time >= timestamp '2001-07-25 00:00:00' group by 1)"""

ORACLE["growth_line"] = W("t_member", "t_order") + _GROWTH_DAILY + """
select m.day, regCount, memberCount, orderCount, cast(gmv_exact as double) as gmv
from m join o on m.day = o.day order by m.day"""

ORACLE["gmv_before"] = W("t_order") + f"""
select coalesce({money('origin_price')}, 0.0) as totalGmv
from t_order where create_time < timestamp '2001-07-25 00:00:00'"""

ORACLE["gmv_cumulative"] = W("t_member", "t_order") + _GROWTH_DAILY + f"""
, b as (select coalesce(sum(cast(origin_price as decimal(18,2))), 0) as before_exact
        from t_order where create_time < timestamp '2001-07-25 00:00:00')
, md as (select {day('create_time')} as day, count(id) as n from t_member
         where create_time is not null group by 1)
, od as (select {day('create_time')} as day, count(order_id) as n from t_order
         where create_time is not null group by 1)
select m.day, regCount, memberCount, orderCount, cast(gmv_exact as double) as gmv,
       cast(b.before_exact + sum(gmv_exact) over (order by m.day rows between unbounded preceding
            and current row) as double) as totalGmv,
       cast((select sum(n) from md where md.day <= m.day) as bigint) as totalMembers,
       cast((select sum(n) from od where od.day <= m.day) as bigint) as totalOrders
from m join o on m.day = o.day cross join b order by m.day"""

ORACLE["wow_reg"] = W("t_member") + f"""
select {day('create_time')} as day, count(id) as regCount from t_member
where create_time >= timestamp '2001-07-18 00:00:00' and create_time < timestamp '2001-08-01 00:00:00'
group by 1"""

ORACLE["wow_order"] = W("t_order") + f"""
select {day('create_time')} as day, count(order_id) as orderCount from t_order
where create_time >= timestamp '2001-07-18 00:00:00' and create_time < timestamp '2001-08-01 00:00:00'
group by 1"""


def _wow_compare(table: str, id_col: str) -> str:
    return W(table) + f"""
, d as (select datediff('day', cast(create_time as date), date '2001-08-01') as d from {table}
        where create_time >= timestamp '2001-07-18 00:00:00'
          and create_time < timestamp '2001-08-01 00:00:00' and {id_col} is not null)
, c as (select ((d - 1) % 7) + 1 as dayOffset, count(case when d <= 7 then 1 end) as thisWeek,
               count(case when d > 7 then 1 end) as lastWeek from d group by 1)
select s.dayOffset, coalesce(c.thisWeek, 0) as thisWeek, coalesce(c.lastWeek, 0) as lastWeek
from (select cast(range as integer) as dayOffset from range(1, 8)) s
left join c on s.dayOffset = c.dayOffset order by s.dayOffset"""


ORACLE["wow_compare_reg"] = _wow_compare("t_member", "id")
ORACLE["wow_compare_order"] = _wow_compare("t_order", "order_id")

ORACLE["remind_free"] = W("t_coupon_member") + f"""
select {day('create_time')} as day, count(member_id) as freeCount from t_coupon_member
where coupon_id = 1 and coupon_channel = 2 and create_time >= timestamp '2024-01-24 00:00:00'
group by 1"""

ORACLE["remind_coupon"] = W("t_coupon_member") + f"""
select {day('create_time')} as day, count(member_id) as couponCount from t_coupon_member
where coupon_id <> 1 and create_time >= timestamp '2024-01-24 00:00:00'
group by 1"""

ORACLE["remind_expiry"] = W("t_coupon_member") + """
select kind, daysLeft, count(distinct member_id) as memberCount from (
  select case when coupon_id = 1 then 'free' else 'paid' end as kind,
         cast(datediff('day', cast(create_time as date), date '2024-01-31') - 8 as integer) as daysLeft,
         member_id
  from t_coupon_member
  where create_time >= timestamp '2024-01-16 00:00:00' and create_time < timestamp '2024-01-23 00:00:00') t
where (kind = 'free' and daysLeft in (1, 2, 3, 4, 5, 6, 7)) or (kind = 'paid' and daysLeft in (1, 3, 5, 7))
group by kind, daysLeft"""

# ----------------------------------------------------------------- tags

_ALL = ("t_member", "t_order", "t_order_commodity", "t_coupon", "t_coupon_member",
        "t_delivery", "t_feedback")

_TAG_PARTS = f"""
, member_base as (
  select id as memberId, phone, sex, member_channel as channel, mp_open_id as subOpenId,
         address_default_id as address, {day('create_time')} as regTime from t_member)
, order_behavior as (
  select o.member_id as memberId, count(o.order_id) as orderCount,
         {day('max(o.create_time)')} as orderTime,
         cast(sum(cast(o.pay_price as decimal(18,2))) as double) as orderMoney,
         list_sort(list_distinct(list(oc.commodity_id))) as favGoods
  from t_order o left join t_order_commodity oc on o.order_id = oc.order_id
  group by o.member_id)
, order_behavior_by_order as (
  select o.memberId, o.orderCount, o.orderTime, o.orderMoney, coalesce(g.favGoods, []) as favGoods
  from (select member_id as memberId, count(*) as orderCount, {day('max(create_time)')} as orderTime,
               cast(sum(cast(pay_price as decimal(18,2))) as double) as orderMoney
        from t_order group by member_id) o
  left join (select o.member_id as memberId, list_sort(list(distinct oc.commodity_id)) as favGoods
             from t_order o join t_order_commodity oc on o.order_id = oc.order_id
             group by o.member_id) g on o.memberId = g.memberId)
, free_coupon as (
  select member_id as memberId, {day('create_time')} as freeCouponTime
  from t_coupon_member where coupon_id = 1)
, coupon_times as (
  select member_id as memberId, list_sort(list({day('create_time')})) as couponTimes
  from t_coupon_member where coupon_id <> 1 group by member_id)
, charge_money as (
  select cm.member_id as memberId,
         cast(sum(cast(c.coupon_price as decimal(18,2))) as double) / 2 as chargeMoney
  from t_coupon_member cm left join t_coupon c on cm.coupon_id = c.id
  where cm.coupon_channel <> 1 group by cm.member_id)
, over_time as (
  select cast(epoch(max(arrive_time)) as bigint) - cast(epoch(max(pick_time)) as bigint) as overTime,
         member_id as memberId
  from t_delivery group by member_id)
, feedback as (
  select fb.feedback_type as feedback, fb.member_id as memberId
  from t_feedback fb right join (select max(id) as fid, member_id as memberId
                                 from t_feedback group by member_id) t on fb.id = t.fid)
"""

_TAG_WITH = W(*_ALL) + _TAG_PARTS

ORACLE["tag_member_base"] = _TAG_WITH + "select * from member_base"
ORACLE["tag_order_behavior"] = _TAG_WITH + "select * from order_behavior"
ORACLE["tag_order_behavior_by_order"] = _TAG_WITH + "select * from order_behavior_by_order"
ORACLE["tag_free_coupon"] = _TAG_WITH + "select * from free_coupon"
ORACLE["tag_coupon_times"] = _TAG_WITH + "select * from coupon_times"
ORACLE["tag_charge_money"] = _TAG_WITH + "select * from charge_money"
ORACLE["tag_over_time"] = _TAG_WITH + "select * from over_time"
ORACLE["tag_feedback"] = _TAG_WITH + "select * from feedback"

ORACLE["user_tag"] = _TAG_WITH + """
select m.*, o.orderCount, o.orderTime, o.orderMoney, o.favGoods,
       fb.freeCouponTime, ct.couponTimes, cm.chargeMoney, ot.overTime, f.feedback
from member_base m
left join order_behavior o on m.memberId = o.memberId
left join free_coupon fb on m.memberId = fb.memberId
left join coupon_times ct on m.memberId = ct.memberId
left join charge_money cm on m.memberId = cm.memberId
left join over_time ot on m.memberId = ot.memberId
left join feedback f on m.memberId = f.memberId"""

_USER_TAG_MEMBER = """
, user_tag_member as (
  select m.*, o.orderCount, o.orderTime, o.orderMoney, o.favGoods,
         fb.freeCouponTime, ct.couponTimes, ct.couponCounts, cm.chargeMoney, ot.overTime, f.feedback
  from member_base m
  left join order_behavior_by_order o on m.memberId = o.memberId
  left join (select memberId, max(freeCouponTime) as freeCouponTime from free_coupon
             group by memberId) fb on m.memberId = fb.memberId
  left join (select memberId, list(day order by day) as couponTimes, list(n order by day) as couponCounts
             from (select memberId, day, count(*) as n
                   from (select memberId, unnest(couponTimes) as day from coupon_times) group by memberId, day)
             group by memberId) ct on m.memberId = ct.memberId
  left join charge_money cm on m.memberId = cm.memberId
  left join over_time ot on m.memberId = ot.memberId
  left join feedback f on m.memberId = f.memberId)
"""

ORACLE["user_tag_member"] = _TAG_WITH + _USER_TAG_MEMBER + "select * from user_tag_member"

# ----------------------------------------------------------------- segments


# Kinds of the tag fields, for writing clause predicates in SQL.
_NUMERIC = {"memberid", "sex", "channel", "address", "ordercount", "ordermoney", "chargemoney",
            "overtime", "feedback"}
_ARRAYS = {"favgoods": "num", "coupontimes": "str"}
_FIELDS = {c.lower(): c for c in ("memberId", "phone", "sex", "channel", "subOpenId", "address",
                                  "regTime", "orderCount", "orderTime", "orderMoney", "favGoods",
                                  "freeCouponTime", "couponTimes", "chargeMoney", "overTime",
                                  "feedback")}


def _lit(kind: str, v: str) -> str:
    return repr(float(v)) if kind == "num" else "'" + v.replace("'", "''") + "'"


def sql_clause(name: str, value: str, typ: str) -> str:
    """SQL text of one clause; must-not clauses come back already negated."""
    key = name.lower()
    col = _FIELDS[key]
    if typ == "exists":
        pred = f"{col} is not null" + (f" and len({col}) > 0" if key in _ARRAYS else "")
        return f"coalesce({pred}, false)"
    kind = _ARRAYS.get(key) or ("num" if key in _NUMERIC else "str")
    if key in _ARRAYS:
        x = "x"
    else:
        x = col
    if typ in ("match", "notMatch"):
        p = f"{x} = {_lit(kind, value)}"
    elif typ == "rangeGte":
        p = f"{x} >= {_lit(kind, value)}"
    elif typ == "rangeLte":
        p = f"{x} <= {_lit(kind, value)}"
    elif typ == "rangeBoth":
        lo, hi = value.split("-")
        p = f"{x} between {_lit(kind, lo)} and {_lit(kind, hi)}"
    else:
        raise ValueError(typ)
    if key in _ARRAYS and typ in ("match", "notMatch"):
        p = f"list_contains({col}, {_lit(kind, value)})"
    elif key in _ARRAYS:
        p = f"len(list_filter({col}, lambda x: {p})) > 0"
    p = f"coalesce({p}, false)"
    return f"not {p}" if typ == "notMatch" else p


def sql_segment(clauses) -> tuple[str, str]:
    """(where, matched) SQL for a clause list, combine='any'."""
    should = [sql_clause(c["name"], c["value"], c["type"]) for c in clauses if c["type"] != "notMatch"]
    must_not = [sql_clause(c["name"], c["value"], c["type"]) for c in clauses if c["type"] == "notMatch"]
    where = "(" + " or ".join(should) + ")" if should else "true"
    for p in must_not:
        where += f" and {p}"
    matched = " + ".join(f"cast({p} as integer)" for p in should) if should else "0"
    return where, matched


_TAGS_WITH = _TAG_WITH + _USER_TAG_MEMBER


def _select_sql(clauses):
    where, matched = sql_segment(clauses)
    return _TAGS_WITH + f"""
select memberId, phone, {matched} as matched from user_tag_member where {where}
order by matched desc, memberId"""


ORACLE["segment_select"] = _select_sql(_R.SEGMENT_OR_NOT)
ORACLE["segment_select_mixed"] = _select_sql(_R.SEGMENT_MIXED)
ORACLE["segment_select_not_only"] = _select_sql(_R.SEGMENT_NOT_ONLY)
ORACLE["segment_size"] = _TAGS_WITH + f"""
select count(*) as members from user_tag_member where {sql_segment(_R.SEGMENT_OR_NOT)[0]}"""

ORACLE["segment_export"] = _TAGS_WITH + f"""
select '[' || cast(memberId as varchar) || ',' || coalesce(phone, 'null') || ']' as line from (
  select memberId, phone, {sql_segment(_R.SEGMENT_OR_NOT)[1]} as matched
  from user_tag_member where {sql_segment(_R.SEGMENT_OR_NOT)[0]}
  order by matched desc, memberId) s"""


def _bulk_sql() -> str:
    segs: dict[str, list] = {}
    for sid, name, value, typ in _R.bulk_rule_rows():
        segs.setdefault(sid, []).append({"name": name, "value": value, "type": typ})
    parts = [f"select '{sid}' as segment_id, memberId from user_tag_member where {sql_segment(cl)[0]}"
             for sid, cl in segs.items()]
    return _TAGS_WITH + "\nunion all\n".join(parts)


ORACLE["segment_bulk"] = _bulk_sql()


def _top_sql() -> str:
    segs: dict[str, list] = {}
    for sid, name, value, typ in _R.bulk_rule_rows():
        segs.setdefault(sid, []).append({"name": name, "value": value, "type": typ})
    parts = [f"select '{sid}' as segment_id, cast(row_number() over (order by {sql_segment(cl)[1]} desc, memberId) as integer) as rank, "
             f"memberId, phone, cast({sql_segment(cl)[1]} as integer) as matched from user_tag_member "
             f"where {sql_segment(cl)[0]} qualify rank <= {_R.TOP_K}" for sid, cl in segs.items()]
    return _TAGS_WITH + "\nunion all\n".join(parts)


ORACLE["segment_top"] = _top_sql()


def _sizes_sql() -> str:
    segs: dict[str, list] = {}
    for sid, name, value, typ in _R.range_rule_rows():
        segs.setdefault(sid, []).append({"name": name, "value": value, "type": typ})
    counts = ",\n  ".join(f"count(*) filter (where {sql_segment(cl)[0]}) as {sid}" for sid, cl in segs.items())
    pairs = "\nunion all\n".join(f"select '{sid}' as segment_id, {sid} as members from agg" for sid in segs)
    return (_TAGS_WITH + f", agg as (select\n  {counts}\nfrom user_tag_member), sizes as (\n{pairs})\n"
            "select segment_id, members from sizes where members > 0")


ORACLE["segment_sizes"] = _sizes_sql()


def _counts_sql() -> str:
    rows = _R.catalogue_rows()
    counts = ",\n  ".join(
        f"count(*) filter (where {sql_segment([{'name': n, 'value': v, 'type': t}])[0]}) as c{i}"
        for i, (_, _, n, v, t) in enumerate(rows))
    sel = "\nunion all\n".join(
        f"select '{g}' as tagGroup, '{lbl}' as label, '{n}' as name, '{v}' as value, '{t}' as type, "
        f"c{i} as memberCount from agg" for i, (g, lbl, n, v, t) in enumerate(rows))
    return _TAGS_WITH + f", agg as (select\n  {counts}\nfrom user_tag_member)\n" + sel


ORACLE["tag_counts"] = _counts_sql()

# ----------------------------------------------------------------- hot words

_FIELDS_SQL = "string_split(regexp_replace(value, '\\t+\\z', ''), chr(9))"

ORACLE["hot_words"] = W("search_log") + f"""
select word, count(*) as searchCount from (
  select case when len({_FIELDS_SQL}) > 2 then {_FIELDS_SQL}[3] else 'null' end as word
  from search_log) t
group by word order by searchCount desc, word limit 10"""

ORACLE["hot_words_malformed"] = W("search_log") + f"""
select value as line from search_log where len({_FIELDS_SQL}) <= 2"""

# ----------------------------------------------------------------- change events

_CHANGES = """
with ch as (
  select event_id as seq, ts, user_id, value, event_type,
         case when event_type = 'purchase' then 'order_info' else 'user_info' end as tbl,
         case event_type when 'view' then 'read' when 'signup' then 'create'
                         when 'error' then 'delete' else 'update' end as operation,
         epoch_us(ts) // 1000 as ts_ms
  from events)
, env as (
  select seq, operation, 'ecommerce' as database, tbl as "table", cast(ts_ms as varchar) as timestamp,
         case when tbl = 'order_info' then seq else user_id end as id,
         user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as create_time,
         case when operation in ('update', 'delete') then strftime(ts, '%Y-%m-%d %H:%M:%S') end as operate_time,
         seq % 34 as province_id, 1 + seq % 5 as order_status, value as total_amount, ts_ms
  from ch)
, usr as (
  select *, 'user' || user_id as login_name, 'nick' || (user_id % 10) as nick_name, null::varchar as passwd,
         'N ' || (seq % 100) as name, '138' || lpad(user_id::varchar, 8, '0') as phone_num,
         'user' || user_id || '@example.org' as email, '' as head_img, (1 + seq % 3)::varchar as user_level,
         (date '1990-01-01' + (user_id % 3650)::int)::varchar as birthday,
         case user_id % 3 when 1 then 'F' when 2 then 'M' end as gender, (seq % 2)::varchar as status
  from env)
, env_json as (
  select *, case when "table" = 'order_info'
    then json_object('id', cast(id as varchar), 'user_id', cast(user_id as varchar),
                     'create_time', create_time, 'operate_time', operate_time,
                     'province_id', cast(province_id as varchar),
                     'order_status', cast(order_status as varchar),
                     'total_amount', cast(total_amount as varchar))::varchar
    else json_object('id', cast(id as varchar), 'login_name', login_name, 'nick_name', nick_name, 'passwd', passwd,
                     'name', name, 'phone_num', phone_num, 'email', email, 'head_img', head_img,
                     'user_level', user_level, 'birthday', birthday, 'gender', gender, 'create_time', create_time,
                     'operate_time', operate_time, 'status', status)::varchar end as data_json
  from usr)
"""

ORACLE["cdc_envelope"] = _CHANGES + """
select operation, database, "table", timestamp, data_json from env_json"""

ORACLE["cdc_route_topics"] = _CHANGES + """
select "table" as topic, data_json as value from env_json"""

_TYPED = """
select id, user_id, create_time, operate_time, cast(province_id as integer) as province_id,
       cast(order_status as integer) as order_status, total_amount, timestamp, operation as op"""

ORACLE["cdc_typed_rows"] = _CHANGES + _TYPED + """
from env where "table" = 'order_info'"""

ORACLE["cdc_typed_user_rows"] = _CHANGES + """
select id, login_name, nick_name, passwd, name, phone_num, email, head_img, user_level, birthday, gender,
       create_time, operate_time, status, timestamp, operation as op
from usr where "table" = 'user_info'"""

# Which records are broken, and how, follows from their numbers.
ORACLE["cdc_rejects"] = _CHANGES + """
select case when seq % 101 = 0 then 'not a change record' when seq % 103 = 0 then 'no server.database.table topic'
            when seq % 107 = 0 then 'no operation' when seq % 109 = 0 then 'no row image' else 'good' end as reason,
       count(*) as records, sum(seq)::bigint as "seqSum"
from env group by 1"""

ORACLE["cdc_change_quality"] = _CHANGES + """
select database, "table", count(*) as records, count(*) filter (where id is null) as "withoutKey",
       count(*) filter (where try_strptime(create_time, '%Y-%m-%d %H:%M:%S') is null) as "withoutTime"
from env group by database, "table\""""

ORACLE["cdc_watermark"] = _CHANGES + _TYPED + """,
       strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') as event_time
from env where "table" = 'order_info'"""

ORACLE["cdc_current_state"] = _CHANGES + """
select "table", cast(id as varchar) as id, operation, timestamp, data_json from (
  select *, row_number() over (partition by "table", id order by ts_ms desc, seq desc) as rn
  from env_json) t
where rn = 1 and operation <> 'delete'"""

# The log alone, in its own order.
ORACLE["cdc_snapshot_handover"] = _CHANGES + """
select "table", cast(id as varchar) as id, data_json from (
  select *, row_number() over (partition by "table", id order by seq desc) as rn from env_json) t
where rn = 1 and operation <> 'delete'"""

# A key's chunk follows from the widths; its reads are the state at the chunk's high mark.
ORACLE["cdc_snapshot_handover_log"] = _CHANGES + """
, ends as (select "table", max(id) // 8 + 1 as width, max(seq) as last from env group by "table")
, placed as (
  select env.*, last * (id // width + 1) // 18 + last // 20 as high
  from env join ends using ("table"))
, at_high as (
  select *, row_number() over (partition by "table", id order by seq desc) as rn from placed where seq <= high)
, handed as (
  select "table", 'read' as operation, high as position, id from at_high where rn = 1 and operation <> 'delete'
  union all
  select "table", operation, seq, id from placed where seq > high)
select "table", operation, count(*) as records, sum(position)::bigint as "positionSum", sum(id)::bigint as "idSum"
from handed group by 1, 2"""

ORACLE["cdc_dedup"] = _CHANGES + """
select operation, "table", timestamp, data_json from env_json"""

ORACLE["cdc_ods_partitioned"] = _CHANGES + _TYPED + """,
       strftime(strptime(create_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d') as dt,
       strftime(strptime(create_time, '%Y-%m-%d %H:%M:%S'), '%H') as hr
from env where "table" = 'order_info'"""

ORACLE["cdc_partition_commit"] = _CHANGES + """
, hours as (select distinct strftime(ts, '%Y-%m-%d') as dt, strftime(ts, '%H') as hr,
                   epoch_us(date_trunc('hour', ts)) // 1000 as start_ms
            from env join ch using (seq) where env."table" = 'order_info')
, wm as (select max(ts_ms) - 5000 as wm_ms from env where "table" = 'order_info')
select dt, hr from hours, wm where start_ms + 61 * 60 * 1000 <= wm_ms"""

# Stream forms read back from their sinks: same results as the batch forms.
ORACLE["cdc_route_topics_stream"] = ORACLE["cdc_route_topics"]
ORACLE["cdc_current_state_stream"] = ORACLE["cdc_current_state"]
ORACLE["cdc_dedup_stream"] = ORACLE["cdc_dedup"]
