"""The tag catalogue of the segment page and per-tag member counts.

The catalogue is a parameter list (77 tags in 16 groups), not data: dates
in it are relative to the day the page is shown. :func:`tag_counts` counts
all tags together, as the segments of a rules table, never one job per tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlens.functions.columns import days_before
from memberlens.operators.segments import segment_sizes

# Fixed values of the shop's tag page: (group, label, field, value, type),
# in the page's order. Fields, values and types must equal the page's; the
# labels are English renderings of the page's display labels and stand in
# the output of tag_counts. Date-valued tags are day offsets resolved against as_of.
_SEX = [("sex", "male", "sex", "1", "match"),
        ("sex", "female", "sex", "2", "match"),
        ("sex", "unknown", "sex", "-1", "match")]
_CHANNEL = [("channel", "iOS", "channel", "1", "match"),
            ("channel", "Android", "channel", "2", "match"),
            ("channel", "mini program", "channel", "3", "match"),
            ("channel", "official account", "channel", "4", "match"),
            ("channel", "H5", "channel", "5", "match")]
_HOT = [("hot", "registered", "regTime", "", "exists"),
        ("hot", "profile incomplete", "address", "-1", "match"),
        ("hot", "free coupon claimed", "freeCouponTime", "", "exists"),
        ("hot", "ordered once", "orderCount", "1", "match"),
        ("hot", "ordered again", "orderCount", "2", "rangeGte")]
_SUB = [("subscription", "following", "subOpenId", "null", "notMatch"),
        ("subscription", "not following", "subOpenId", "null", "match")]
_MONEY_RANGES = ["10-50", "50-100", "100-200", "200-500", "500-1000"]
_GOODS = [("coffee", "cappuccino", "1"), ("coffee", "americano", "2"), ("coffee", "mocha", "3"),
          ("coffee", "latte", "4"),
          ("juice", "orange juice", "5"), ("juice", "pomegranate juice", "6"),
          ("juice", "watermelon juice", "7"), ("juice", "mango", "8"), ("juice", "kiwi", "9"),
          ("snacks", "sachima", "10"), ("snacks", "rusk", "11"), ("snacks", "yogurt", "12"),
          ("snacks", "ham", "13"), ("snacks", "burger", "14"),
          ("merchandise", "coffee cup", "15"), ("merchandise", "coffee machine", "16"),
          ("merchandise", "juicer", "17"), ("merchandise", "coffee story", "18"),
          ("merchandise", "key ring", "19")]
_OVER_TIME = [("overTime", "15 minutes", "overTime", "900", "rangeGte"),
              ("overTime", "30 minutes", "overTime", "1800", "rangeGte"),
              ("overTime", "45 minutes", "overTime", "2700", "rangeGte"),
              ("overTime", "over 1 hour", "overTime", "3600", "rangeGte")]
_FEEDBACK = [("feedback", "damaged or spilled", "feedBack", "1", "match"),
             ("feedback", "out of stock", "feedBack", "2", "match"),
             ("feedback", "wrong goods", "feedBack", "3", "match"),
             ("feedback", "complaint", "feedBack", "4", "match")]
RECENT_DAYS = (1, 2, 3, 4, 5, 6, 7)          # "within k days" tags
COUPON_VALIDITY_DAYS = 8                     # coupons lapse 8 days after the claim
FREE_EXPIRY_DAYS = (1, 2, 3, 4, 5, 6, 7)     # free coupon lapses in k days
PAID_EXPIRY_DAYS = (1, 3, 5, 7)              # paid coupon lapses in k days


def tag_catalogue_rows(as_of: str, coupon_as_of: str | None = None) -> list[tuple]:
    """The 77 catalogue tags as ``(tagGroup, label, name, value, type)`` tuples."""
    coupon_as_of = coupon_as_of or as_of
    rows = list(_SEX) + list(_CHANNEL) + list(_HOT) + list(_SUB)
    rows += [("regTime", f"within {k} days", "regTime", days_before(as_of, k), "rangeGte")
             for k in RECENT_DAYS]
    rows += [("orderTime", f"within {k} days", "orderTime", days_before(as_of, k), "rangeGte")
             for k in RECENT_DAYS]
    rows += [("freeCouponExpiry", f"lapses in {k} days", "freeCouponTime",
              days_before(coupon_as_of, COUPON_VALIDITY_DAYS + k), "match") for k in FREE_EXPIRY_DAYS]
    rows += [("couponExpiry", f"lapses in {k} days", "couponTimes",
              days_before(coupon_as_of, COUPON_VALIDITY_DAYS + k), "match") for k in PAID_EXPIRY_DAYS]
    rows += [("chargeMoney", r.replace("-", "~"), "chargeMoney", r, "rangeBoth") for r in _MONEY_RANGES]
    rows += [("orderMoney", r.replace("-", "~"), "orderMoney", r, "rangeBoth") for r in _MONEY_RANGES]
    rows += [(g, label, "favGoods", v, "match") for g, label, v in _GOODS]
    rows += list(_OVER_TIME) + list(_FEEDBACK)
    return rows


CATALOGUE_SCHEMA = "tagGroup string, label string, name string, value string, type string"


def tag_catalogue(spark: SparkSession, as_of: str, coupon_as_of: str | None = None) -> DataFrame:
    """The catalogue as a small DataFrame (77 rows)."""
    return spark.createDataFrame(tag_catalogue_rows(as_of, coupon_as_of), CATALOGUE_SCHEMA)


def tag_counts(tags: DataFrame, catalogue: list[tuple]) -> DataFrame:
    """Members per catalogue tag: ``(tagGroup, label, name, value, type, memberCount)``.

    Each tag is a one-clause segment (a ``notMatch`` tag counts the members
    *not* matching), so the catalogue goes through :func:`segment_sizes` as a
    rules table.
    """
    spark = tags.sparkSession
    rows = [(f"{k:06d}", *r) for k, r in enumerate(catalogue)]
    rules = spark.createDataFrame(rows, f"segment_id string, {CATALOGUE_SCHEMA}")
    counts = segment_sizes(tags, rules).withColumnRenamed("members", "n")
    return (rules.join(counts, "segment_id", "left")
            .select("tagGroup", "label", "name", "value", "type",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("memberCount")))
