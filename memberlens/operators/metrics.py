"""Dashboard metrics: member pies and heat, conversion funnel, growth line,
week-over-week counts and coupon reminders.

Every metric is a single lazy plan. Where the original job ran several
actions and stitched the results on the driver (one ``count()`` per
funnel stage, a driver-side ``getDouble`` for the earlier GMV), the stages
are computed in one plan here: one-row aggregates are combined with a
cross join of single rows (a broadcast nested-loop join of 1 x 1 rows),
never with a driver round trip.

Scale notes
-----------
* All group-bys run as partial (map-side) plus final aggregation, so a
  member or day that holds a third of the rows is pre-reduced in every
  map task before the shuffle; no group is ever collected into one task.
* Day-grain results have one row per calendar day, so the running GMV
  window over them (no partition key) handles a few hundred rows at most.
* Time filters compare with literals of the column's own type, so they
  are pushed into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from memberlens.functions.columns import (at_midnight, day_string, days_before, money_sum,
                                          typed_literal)

NULL_SENTINEL = "null"   # the string the shop database stores for "no value"


# --------------------------------------------------------------------- members

def member_sex(member: DataFrame) -> DataFrame:
    """Members per sex code: ``(memberSex, sexCount)``."""
    return (member.groupBy(F.col("sex").alias("memberSex"))
                  .agg(F.count("id").alias("sexCount")))


def member_channel(member: DataFrame) -> DataFrame:
    """Members per sign-up channel: ``(memberChannel, channelCount)``."""
    return (member.groupBy(F.col("member_channel").alias("memberChannel"))
                  .agg(F.count("id").alias("channelCount")))


def member_mp_sub(member: DataFrame) -> DataFrame:
    """One row ``(subCount, unSubCount)``: followers of the media account.

    The database marks "not following" with the *string* ``'null'``; a real
    SQL NULL counts in neither column, as in the original query.
    """
    oid = F.col("mp_open_id")
    return member.agg(F.count(F.when(oid != NULL_SENTINEL, 1)).alias("subCount"),
                      F.count(F.when(oid == NULL_SENTINEL, 1)).alias("unSubCount"))


def _orders_per_member(order: DataFrame, status: int | None = None) -> DataFrame:
    o = order if status is None else order.filter(F.col("order_status") == status)
    return o.groupBy("member_id").agg(F.count(F.lit(1)).alias("orderCount"))


def _distinct_members(coupon_member: DataFrame, approx: bool) -> DataFrame:
    # Exact: a two-phase distinct (partial by member in the map tasks).
    # approx=True: a HyperLogLog++ sketch per task, merged once (5 %
    # relative standard deviation by default; no shuffle of member ids).
    count = (F.approx_count_distinct("member_id") if approx else F.count_distinct("member_id"))
    return coupon_member.agg(count.alias("coupon"))


def member_heat(member: DataFrame, order: DataFrame, coupon_member: DataFrame,
                approx: bool = False) -> DataFrame:
    """One row ``(coupon, reg, complete, order, orderAgain)``.

    * reg / complete: members without / with a phone number;
    * order / orderAgain: members with exactly one / at least two orders
      (any status);
    * coupon: distinct members holding a coupon (``approx=True`` uses a
      sketch instead of an exact distinct count).
    """
    phone = F.col("phone")
    reg_complete = member.agg(F.count(F.when(phone == NULL_SENTINEL, 1)).alias("reg"),
                              F.count(F.when(phone != NULL_SENTINEL, 1)).alias("complete"))
    n = F.col("orderCount")
    order_again = (_orders_per_member(order)
                   .agg(F.count(F.when(n == 1, 1)).alias("order"),
                        F.count(F.when(n >= 2, 1)).alias("orderAgain")))
    coupon = _distinct_members(coupon_member, approx)
    # Each side is a global aggregate with exactly one row: a proven size
    # bound, so the broadcast is explicit and does not depend on estimates.
    return (coupon.crossJoin(F.broadcast(reg_complete)).crossJoin(F.broadcast(order_again))
                  .select("coupon", "reg", "complete", "order", "orderAgain"))


def member_overview(member: DataFrame, order: DataFrame, coupon_member: DataFrame,
                    approx: bool = False) -> DataFrame:
    """All member pies and the heat row in one long result ``(metric, key, value)``.

    ``key`` is the code for per-code metrics and NULL for single numbers.
    The member table is scanned once: a single aggregate over the grouping
    sets ``(sex), (member_channel), ()`` yields the sex pie, the channel pie
    and the member totals (partial aggregation right after the expand).
    """
    oid, phone = F.col("mp_open_id"), F.col("phone")
    sets = (member.groupingSets([["sex"], ["member_channel"], []], "sex", "member_channel")
            .agg(F.grouping_id().alias("gid"),
                 F.count("id").alias("n"),
                 F.count(F.when(oid != NULL_SENTINEL, 1)).alias("subCount"),
                 F.count(F.when(oid == NULL_SENTINEL, 1)).alias("unSubCount"),
                 F.count(F.when(phone == NULL_SENTINEL, 1)).alias("reg"),
                 F.count(F.when(phone != NULL_SENTINEL, 1)).alias("complete")))
    n = F.col("orderCount")
    orders = (_orders_per_member(order)
              .agg(F.count(F.when(n == 1, 1)).alias("order"),
                   F.count(F.when(n >= 2, 1)).alias("orderAgain")))
    coupon = _distinct_members(coupon_member, approx)

    def entry(metric, key, value):
        return F.struct(metric.alias("metric"), key.alias("key"), value.cast("bigint").alias("value"))

    # grouping_id: 1 = sex pie row, 2 = channel pie row, 3 = totals row.
    gid = F.col("gid")
    pie = F.array(entry(F.when(gid == 1, F.lit("sex")).otherwise(F.lit("channel")),
                        F.when(gid == 1, F.col("sex").cast("string"))
                         .otherwise(F.col("member_channel").cast("string")),
                        F.col("n")))
    names = ("subCount", "unSubCount", "coupon", "reg", "complete", "order", "orderAgain")
    totals = F.array(*[entry(F.lit(c), F.lit(None).cast("string"), F.col(c)) for c in names])
    # ``sets`` is referenced once (9 rows), so the member table is read once.
    # orders and coupon are global aggregates (exactly one row each).
    return (sets.crossJoin(F.broadcast(orders)).crossJoin(F.broadcast(coupon))
                .select(F.explode(F.when(gid == 3, totals).otherwise(pie)).alias("m"))
                .select("m.*"))


def member_overview_document(member: DataFrame, order: DataFrame, coupon_member: DataFrame,
                             approx: bool = False) -> DataFrame:
    """The member dashboard as one JSON document (``document``), as the job printed it.

    ``{"memberSexes": [{"memberSex", "sexCount"}...], "memberChannels":
    [{"memberChannel", "channelCount"}...], "memberMpSubs": [{"subCount",
    "unSubCount"}], "memberHeat": {"reg", "complete", "order", "orderAgain",
    "coupon"}}``; lists sorted by code. Folded from the long form (one row
    per code and total), so the document is built from a handful of rows.
    """
    long = member_overview(member, order, coupon_member, approx)
    m, k, v = F.col("metric"), F.col("key"), F.col("value")

    def total(name):
        return F.max(F.when(m == name, v))

    doc = long.agg(
        F.array_sort(F.collect_list(F.when(m == "sex", F.struct(k.cast("int").alias("memberSex"),
                                                               v.alias("sexCount"))))).alias("memberSexes"),
        F.array_sort(F.collect_list(F.when(m == "channel", F.struct(k.cast("int").alias("memberChannel"),
                                                                   v.alias("channelCount")))))
         .alias("memberChannels"),
        F.array(F.struct(total("subCount").alias("subCount"),
                         total("unSubCount").alias("unSubCount"))).alias("memberMpSubs"),
        F.struct(*[total(c).alias(c) for c in ("reg", "complete", "order", "orderAgain", "coupon")])
         .alias("memberHeat"))
    return doc.select(F.to_json(F.struct("memberSexes", "memberChannels", "memberMpSubs",
                                         "memberHeat")).alias("document"))


# --------------------------------------------------------------------- funnel

def conversion_funnel(order: DataFrame, coupon_member: DataFrame, present: int = 1000,
                      click: int = 800, add_cart: int = 600) -> DataFrame:
    """One row ``(present, click, addCart, order, orderAgain, chargeCoupon)``.

    * order: distinct members with a paid (status 2) order;
    * orderAgain: members with more than one paid order;
    * chargeCoupon: members of orderAgain who bought a coupon on channel 1.

    The first three stages are not measured by the shop; they are
    parameters. Both join sides are unique per member (aggregated), so the
    join is one-to-one and all three counts come from one aggregate.
    """
    paid = _orders_per_member(order, status=2)
    charged = (coupon_member.filter(F.col("coupon_channel") == 1)
                            .select("member_id").distinct()
                            .withColumn("charged", F.lit(True)))
    n = F.col("orderCount")
    again = n > 1
    return (paid.join(charged, "member_id", "left")
                .agg(F.count(F.lit(1)).alias("order"),
                     F.count(F.when(again, 1)).alias("orderAgain"),
                     F.count(F.when(again & F.col("charged"), 1)).alias("chargeCoupon"))
                .select(F.lit(present).cast("bigint").alias("present"),
                        F.lit(click).cast("bigint").alias("click"),
                        F.lit(add_cart).cast("bigint").alias("addCart"),
                        "order", "orderAgain", "chargeCoupon"))


# --------------------------------------------------------------------- growth

def _since(df: DataFrame, column: str, day: str) -> DataFrame:
    return df.filter(F.col(column) >= typed_literal(df, column, at_midnight(day)))


def _before(df: DataFrame, column: str, day: str) -> DataFrame:
    return df.filter(F.col(column) < typed_literal(df, column, at_midnight(day)))


def _daily_members(member: DataFrame, start: str) -> DataFrame:
    return (_since(member, "create_time", start)
            .groupBy(day_string("create_time").alias("day"))
            .agg(F.count("id").alias("regCount"), F.max("id").alias("memberCount")))


def _daily_orders(order: DataFrame, start: str) -> DataFrame:
    return (_since(order, "create_time", start)
            .groupBy(day_string("create_time").alias("day"))
            .agg(F.max("order_id").alias("orderCount"),
                 F.sum(F.col("origin_price").cast("decimal(18,2)")).alias("gmv_exact")))


def growth_line(member: DataFrame, order: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Daily growth since ``as_of - days``: ``(day, regCount, memberCount, orderCount, gmv)``.

    As in the shop's job, ``memberCount``/``orderCount`` are the largest
    ids seen that day (stand-ins for running totals), there is no upper
    time bound, and days without registrations or without orders are
    dropped by the inner join.
    """
    start = days_before(as_of, days)
    return (_daily_members(member, start)
            .join(_daily_orders(order, start), "day", "inner")
            .select("day", "regCount", "memberCount", "orderCount",
                    F.col("gmv_exact").cast("double").alias("gmv"))
            .orderBy("day"))


def gmv_before(order: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """One row ``totalGmv``: order value strictly before ``as_of - days`` (0 when none)."""
    start = days_before(as_of, days)
    return (_before(order, "create_time", start)
            .agg(F.coalesce(money_sum("origin_price"), F.lit(0.0)).alias("totalGmv")))


def gmv_cumulative(member: DataFrame, order: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """The growth line with the running totals the dashboard plots.

    ``(day, regCount, memberCount, orderCount, gmv, totalGmv, totalMembers,
    totalOrders)``:

    * ``totalGmv``: all order value before the window plus the daily GMV of
      every growth-line day up to and including this one (the original
      loop summed over the joined days);
    * ``totalMembers`` / ``totalOrders``: true running counts of all members
      registered / orders placed up to the end of the day, over the whole
      history (what the max-id columns stand in for).

    Each table is read once: one aggregate keyed by day inside the window
    and by NULL for the history before it; running sums over those
    day-grain results (NULL row first) give history + days so far.
    """
    start = days_before(as_of, days)

    def per_day(df: DataFrame, id_col: str, extra: list) -> DataFrame:
        ct = F.col("create_time")
        inside = ct >= typed_literal(df, "create_time", at_midnight(start))
        return (df.filter(ct.isNotNull())
                  .groupBy(F.when(inside, day_string(ct)).alias("day"))
                  .agg(F.max(F.when(inside, F.col(id_col))).alias("maxId"),
                       F.count(id_col).alias("n"), *extra))

    running = (Window.orderBy(F.col("day").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    orders = (per_day(order, "order_id",
                      [F.sum(F.col("origin_price").cast("decimal(18,2)")).alias("gmv_exact")])
              .withColumn("totalOrders", F.sum("n").over(running)))
    members = (per_day(member, "id", [])
               .withColumn("totalMembers", F.sum("n").over(running))
               .filter(F.col("day").isNotNull())
               .select("day", F.col("n").alias("regCount"), F.col("maxId").alias("memberCount"),
                       "totalMembers"))
    # Only days that survive the inner join with registrations add to
    # totalGmv, as in the original loop over the joined rows.
    kept = (orders.join(members, "day", "left")
                  .filter(F.col("day").isNull() | F.col("regCount").isNotNull())
                  .withColumn("totalGmv", F.coalesce(F.sum("gmv_exact").over(running), F.lit(0))))
    return (kept.filter(F.col("day").isNotNull())
                .select("day", "regCount", "memberCount", F.col("maxId").alias("orderCount"),
                        F.col("gmv_exact").cast("double").alias("gmv"),
                        F.col("totalGmv").cast("double").alias("totalGmv"),
                        "totalMembers", "totalOrders")
                .orderBy("day"))


# --------------------------------------------------------------------- week over week

def _window_days(df: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    lo = typed_literal(df, column, at_midnight(days_before(as_of, days)))
    hi = typed_literal(df, column, at_midnight(as_of))
    return df.filter((F.col(column) >= lo) & (F.col(column) < hi))


def wow_reg(member: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """Registrations per day in ``[as_of - days, as_of)``: ``(day, regCount)``."""
    return (_window_days(member, "create_time", as_of, days)
            .groupBy(day_string("create_time").alias("day"))
            .agg(F.count("id").alias("regCount")))


def wow_order(order: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """Orders per day in ``[as_of - days, as_of)``: ``(day, orderCount)``."""
    return (_window_days(order, "create_time", as_of, days)
            .groupBy(day_string("create_time").alias("day"))
            .agg(F.count("order_id").alias("orderCount")))


def wow_compare(df: DataFrame, id_col: str, as_of: str, time_col: str = "create_time",
                week: int = 7) -> DataFrame:
    """Week-over-week chart rows ``(dayOffset, thisWeek, lastWeek)``.

    ``dayOffset`` k in 1..week pairs the day ``as_of - k`` (this week) with
    ``as_of - week - k`` (last week). Offsets without rows are filled with
    zeros from a ``week``-row frame.
    """
    offset = F.datediff(F.lit(as_of).cast("date"), F.to_date(F.col(time_col)))
    counts = (_window_days(df, time_col, as_of, 2 * week)
              .filter(F.col(id_col).isNotNull())
              .select(offset.alias("d"))
              .groupBy((((F.col("d") - 1) % week) + 1).alias("dayOffset"))
              .agg(F.count(F.when(F.col("d") <= week, 1)).alias("thisWeek"),
                   F.count(F.when(F.col("d") > week, 1)).alias("lastWeek")))
    spark = df.sparkSession
    slots = spark.range(1, week + 1).select(F.col("id").cast("int").alias("dayOffset"))
    return (slots.join(counts, "dayOffset", "left")
                 .select("dayOffset",
                         F.coalesce("thisWeek", F.lit(0).cast("bigint")).alias("thisWeek"),
                         F.coalesce("lastWeek", F.lit(0).cast("bigint")).alias("lastWeek"))
                 .orderBy("dayOffset"))


# --------------------------------------------------------------------- coupon reminders

def remind_free(coupon_member: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Free first-cup coupons (id 1, channel 2) claimed per day since ``as_of - days``."""
    cm = coupon_member.filter((F.col("coupon_id") == 1) & (F.col("coupon_channel") == 2))
    return (_since(cm, "create_time", days_before(as_of, days))
            .groupBy(day_string("create_time").alias("day"))
            .agg(F.count("member_id").alias("freeCount")))


def remind_coupon(coupon_member: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Paid coupons (id other than 1) bought per day since ``as_of - days``."""
    cm = coupon_member.filter(F.col("coupon_id") != 1)
    return (_since(cm, "create_time", days_before(as_of, days))
            .groupBy(day_string("create_time").alias("day"))
            .agg(F.count("member_id").alias("couponCount")))


# Fixed values of the shop's reminder charts: a coupon is valid for 8 days
# after the claim day; free first-cup coupons are reminded 1..7 days before
# they lapse, paid coupons 1, 3, 5 and 7 days before.
COUPON_VALIDITY_DAYS = 8
FREE_REMIND_OFFSETS = (1, 2, 3, 4, 5, 6, 7)
PAID_REMIND_OFFSETS = (1, 3, 5, 7)


def remind_expiry(coupon_member: DataFrame, as_of: str, validity: int = COUPON_VALIDITY_DAYS,
                  free_offsets=FREE_REMIND_OFFSETS, paid_offsets=PAID_REMIND_OFFSETS) -> DataFrame:
    """Members whose coupons lapse in k days: ``(kind, daysLeft, memberCount)``.

    A coupon claimed on day ``as_of - (validity + k)`` lapses in k days.
    ``kind`` is ``free`` for the first-cup coupon (id 1) and ``paid``
    otherwise; members are counted once per (kind, k).
    """
    horizon = validity + max(max(free_offsets), max(paid_offsets))
    lo = days_before(as_of, horizon)
    hi = days_before(as_of, validity)
    cm = coupon_member.filter(
        (F.col("create_time") >= typed_literal(coupon_member, "create_time", at_midnight(lo)))
        & (F.col("create_time") < typed_literal(coupon_member, "create_time", at_midnight(hi))))
    days_left = (F.datediff(F.lit(as_of).cast("date"), F.to_date("create_time")) - validity)
    kind = F.when(F.col("coupon_id") == 1, F.lit("free")).otherwise(F.lit("paid"))
    keep = (((F.col("kind") == "free") & F.col("daysLeft").isin(*free_offsets))
            | ((F.col("kind") == "paid") & F.col("daysLeft").isin(*paid_offsets)))
    return (cm.select(kind.alias("kind"), days_left.cast("int").alias("daysLeft"), "member_id")
              .filter(keep)
              .groupBy("kind", "daysLeft")
              .agg(F.count_distinct("member_id").alias("memberCount")))
