"""The wide user-tag table: one document per member for segment selection.

Two forms exist:

* :func:`user_tag` reproduces the shop's job row for row, including its
  two fan-outs: order value and order count are taken *after* joining the
  order lines (an order with n lines counts n times), and every free
  coupon of a member adds a row.
* :func:`user_tag_member` is the intended table: exactly one row per
  member, counts and money at order grain, the latest free-coupon day, and
  each paid-coupon day once with its count.

Plan shape (both forms): every side table is reduced to one row per
member (or per member and day) by a partial + final aggregate, so all
sides arrive hash-partitioned on the member key and the chain of left
joins needs no further exchange. Raw rows are never gathered per member:
list-valued tags are pre-aggregated to ``(member, day, n)`` in the map
tasks first, so a member that owns a third of all rows still sends only a
few rows per map task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.functions.columns import day_string

TAG_COLUMNS = ("memberId", "phone", "sex", "channel", "subOpenId", "address", "regTime",
               "orderCount", "orderTime", "orderMoney", "favGoods", "freeCouponTime",
               "couponTimes", "chargeMoney", "overTime", "feedback")

FREE_COUPON_ID = 1       # fixed value: coupon id 1 is the free first cup
CHARGE_FREE_CHANNEL = 1  # fixed value: coupons from channel 1 carry no charge
FANOUT_CHUNK = 4096      # largest array built when re-expanding the free-coupon fan-out


def tag_member_base(member: DataFrame) -> DataFrame:
    """``memberId, phone, sex, channel, subOpenId, address, regTime``."""
    return member.select(F.col("id").alias("memberId"), "phone", "sex",
                         F.col("member_channel").alias("channel"),
                         F.col("mp_open_id").alias("subOpenId"),
                         F.col("address_default_id").alias("address"),
                         day_string("create_time").alias("regTime"))


def _member_goods(orders: DataFrame, order_commodity: DataFrame) -> DataFrame:
    """``(memberId, goods)``: sorted distinct goods per member.

    The order lines are joined to their order's member as they are (one
    shuffle of the line table; ``order_id`` is unique in the orders, so an
    order with a huge number of lines is a skewed many-to-one inner join
    that AQE splits), reduced to distinct ``(member, good)`` pairs in the
    map tasks, and only then gathered into one list per member.
    """
    return (order_commodity.select("order_id", "commodity_id")
            .join(orders.select("order_id", "member_id"), "order_id")
            .select("member_id", "commodity_id").distinct()
            .groupBy(F.col("member_id").alias("memberId"))
            .agg(F.array_sort(F.collect_list("commodity_id")).alias("goods")))


def tag_order_behavior(order: DataFrame, order_commodity: DataFrame) -> DataFrame:
    """Order tags at *line* grain, as the shop computed them.

    ``memberId, orderCount, orderTime, orderMoney, favGoods``: an order
    with n lines counts n times and adds its price n times; an order
    without lines counts once. ``favGoods`` is the sorted distinct list of
    goods bought. Orders and lines are read once: the joined rows are
    reduced to ``(member, good)`` in the map tasks and then to the member.
    """
    per_good = (order.select("order_id", "member_id", "pay_price", "create_time")
                .join(order_commodity.select("order_id", "commodity_id"), "order_id", "left")
                .groupBy("member_id", "commodity_id")
                .agg(F.count(F.lit(1)).alias("n"), F.max("create_time").alias("latest"),
                     F.sum(F.col("pay_price").cast("decimal(18,2)")).alias("money")))
    return (per_good.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.sum("n").alias("orderCount"), day_string(F.max("latest")).alias("orderTime"),
                 F.sum("money").cast("double").alias("orderMoney"),
                 F.array_sort(F.collect_list("commodity_id")).alias("favGoods")))


def tag_order_behavior_by_order(order: DataFrame, order_commodity: DataFrame) -> DataFrame:
    """Order tags at *order* grain: each order counts once, money once.

    Count, last day and money come from the orders alone, the goods from
    the lines (a second, cheap scan of two order columns).
    """
    orders = order.select("order_id", "member_id", "pay_price", "create_time")
    counts = (orders.groupBy(F.col("member_id").alias("memberId"))
              .agg(F.count(F.lit(1)).alias("orderCount"),
                   day_string(F.max("create_time")).alias("orderTime"),
                   F.sum(F.col("pay_price").cast("decimal(18,2)")).cast("double").alias("orderMoney")))
    return (counts.join(_member_goods(orders, order_commodity), "memberId", "left")
                  .select("memberId", "orderCount", "orderTime", "orderMoney",
                          F.coalesce(F.col("goods"), F.array().cast("array<bigint>"))
                           .alias("favGoods")))


def tag_free_coupon(coupon_member: DataFrame) -> DataFrame:
    """``memberId, freeCouponTime``: one row per free first-cup coupon (not aggregated)."""
    return (coupon_member.filter(F.col("coupon_id") == FREE_COUPON_ID)
            .select(F.col("member_id").alias("memberId"),
                    day_string("create_time").alias("freeCouponTime")))


def _free_coupon_days(coupon_member: DataFrame) -> DataFrame:
    """``(memberId, freeCouponTime, n)``: free coupons per member and day."""
    return (tag_free_coupon(coupon_member)
            .groupBy("memberId", "freeCouponTime").agg(F.count(F.lit(1)).alias("n")))


def _expand_days(entries: str) -> F.Column:
    """Sorted ``array<struct<day, n>>`` -> the day list with each day n times."""
    return F.flatten(F.transform(F.array_sort(F.col(entries)),
                                 lambda e: F.array_repeat(e["day"], e["n"].cast("int"))))


def tag_coupon_times(coupon_member: DataFrame) -> DataFrame:
    """``memberId, couponTimes``: days of every paid coupon, sorted, duplicates kept."""
    per_day = (coupon_member.filter(F.col("coupon_id") != FREE_COUPON_ID)
               .groupBy("member_id", day_string("create_time").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    # A claim without a time has no day: it keeps the member in the result
    # but adds no entry (the list skips NULLs).
    return (per_day.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.collect_list(F.when(F.col("day").isNotNull(), F.struct("day", "n")))
                 .alias("entries"))
            .select("memberId", _expand_days("entries").alias("couponTimes")))


def tag_charge_money(coupon_member: DataFrame, coupon: DataFrame) -> DataFrame:
    """``memberId, chargeMoney``: half the price of coupons not from channel 1.

    Claims are first reduced to ``(member, coupon, n)`` in the map tasks,
    so the join with the coupon dimension sees one row per member and
    coupon, and a coupon bought by everyone is already collapsed. The
    optimizer broadcasts the dimension when its size statistics are under
    the broadcast threshold and otherwise uses a shuffle join (AQE splits a
    skewed coupon id on the streamed side).
    """
    cm = (coupon_member.filter(F.col("coupon_channel") != CHARGE_FREE_CHANNEL)
          .groupBy("member_id", "coupon_id").agg(F.count(F.lit(1)).alias("n")))
    priced = cm.join(coupon.select(F.col("id").alias("coupon_id"), "coupon_price"),
                     "coupon_id", "left")
    total = F.sum(F.col("coupon_price").cast("decimal(18,2)") * F.col("n"))
    return (priced.groupBy(F.col("member_id").alias("memberId"))
            .agg((total.cast("double") / 2).alias("chargeMoney")))


def tag_over_time(delivery: DataFrame) -> DataFrame:
    """``memberId, overTime``: seconds between the latest arrival and the latest pick-up."""
    def secs(c):
        return F.unix_timestamp(F.max(F.col(c).cast("timestamp")))
    return (delivery.groupBy(F.col("member_id").alias("memberId"))
            .agg((secs("arrive_time") - secs("pick_time")).alias("overTime")))


def tag_feedback(feedback: DataFrame) -> DataFrame:
    """``memberId, feedback``: the type of the member's newest (largest id) feedback."""
    return (feedback.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.max_by("feedback_type", "id").alias("feedback")))


def _coupon_profile(coupon_member: DataFrame, coupon: DataFrame) -> DataFrame:
    """Latest free-coupon day, paid-coupon days and charge money in one pass.

    One scan of the claims: claims are first reduced to
    ``(member, coupon, channel class, day, n)`` map-side, priced by a join
    with the coupon dimension, then folded per member and day, and per
    member: ``couponTimes`` holds each day once, ``couponCounts`` how often.
    """
    free = F.col("coupon_id") == FREE_COUPON_ID
    charged = F.col("coupon_channel") != CHARGE_FREE_CHANNEL
    reduced = (coupon_member
               .groupBy("member_id", "coupon_id", charged.alias("charged"),
                        day_string("create_time").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    priced = reduced.join(coupon.select(F.col("id").alias("coupon_id"), "coupon_price"),
                          "coupon_id", "left")
    # One entry per member and day: the lists are bounded by the calendar.
    daily = (priced.groupBy("member_id", "day")
             .agg(F.max(free).alias("free"), F.sum(F.when(~free, F.col("n"))).alias("nPaid"),
                  F.count(F.when(F.col("charged"), 1)).alias("nCharged"),
                  F.sum(F.when(F.col("charged"),
                               F.col("coupon_price").cast("decimal(18,2)") * F.col("n"))).alias("charge")))
    paid = F.col("nPaid").isNotNull()
    return (daily.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.max(F.when(F.col("free"), F.col("day"))).alias("freeCouponTime"),
                 F.array_sort(F.collect_list(F.when(paid & F.col("day").isNotNull(), F.struct("day", "nPaid"))))
                  .alias("paid"),
                 F.count(F.when(paid, 1)).alias("paidDays"),
                 F.sum("nCharged").alias("nCharged"), F.sum("charge").alias("charge"))
            .select("memberId", "freeCouponTime",
                    F.when(F.col("paidDays") > 0, F.col("paid.day")).alias("couponTimes"),
                    F.when(F.col("paidDays") > 0, F.col("paid.nPaid")).alias("couponCounts"),
                    F.when(F.col("nCharged") > 0, F.col("charge").cast("double") / 2).alias("chargeMoney")))


def user_tag(t: dict[str, DataFrame]) -> DataFrame:
    """The wide tag table exactly as the shop built it (see module doc).

    ``t`` maps the shop table names (``t_member``, ``t_order``, ...) to
    DataFrames. A member with k free coupons appears k times.
    """
    wide = (tag_member_base(t["t_member"])
            .join(tag_order_behavior(t["t_order"], t["t_order_commodity"]), "memberId", "left")
            .join(tag_coupon_times(t["t_coupon_member"]), "memberId", "left")
            .join(tag_charge_money(t["t_coupon_member"], t["t_coupon"]), "memberId", "left")
            .join(tag_over_time(t["t_delivery"]), "memberId", "left")
            .join(tag_feedback(t["t_feedback"]), "memberId", "left"))
    # The free-coupon fan-out is joined pre-aggregated per (member, day)
    # and expanded afterwards, so the shuffle carries one row per day. The
    # expansion is done in chunks of at most FANOUT_CHUNK copies, so no
    # generated array grows with a member's number of coupons.
    n = F.col("n")
    chunk = F.col("_chunk")
    fanned = (wide.join(_free_coupon_days(t["t_coupon_member"]), "memberId", "left")
                  .withColumn("_chunk", F.explode_outer(
                      F.sequence(F.lit(0), F.floor((n - 1) / FANOUT_CHUNK).cast("int"))))
                  # the chunks of one member and day go to different tasks
                  .repartition("memberId", "freeCouponTime", "_chunk")
                  .withColumn("freeCouponTime", F.explode_outer(F.array_repeat(
                      "freeCouponTime",
                      # least() skips NULLs: members without free coupons keep n = NULL
                      F.when(n.isNotNull(),
                             F.least(F.lit(FANOUT_CHUNK), n - chunk * FANOUT_CHUNK)).cast("int")))))
    return fanned.select(*TAG_COLUMNS)


def user_tag_member(t: dict[str, DataFrame]) -> DataFrame:
    """One row per member: order-grain order tags and the latest free-coupon day."""
    wide = (tag_member_base(t["t_member"])
            .join(tag_order_behavior_by_order(t["t_order"], t["t_order_commodity"]),
                  "memberId", "left")
            .join(_coupon_profile(t["t_coupon_member"], t["t_coupon"]), "memberId", "left")
            .join(tag_over_time(t["t_delivery"]), "memberId", "left")
            .join(tag_feedback(t["t_feedback"]), "memberId", "left"))
    return wide.select(*TAG_COLUMNS, "couponCounts")
