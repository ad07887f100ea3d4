"""Shop tables derived from the driver's generic test tables.

The generated data set has no member/order/coupon tables of its own, so
the mapping below (recorded in FIXTURES.md) derives them: customers become
members, orders stay orders, order lines give the goods bought, parts give
the coupon prices, and the event stream gives coupon claims, feedback,
search-log lines and database change records.

Each view is expressed with the DataFrame API so that the column pruning
and filter pushdown of the operators reach the parquet scan. The same
mapping is kept as SQL text in :data:`VIEW_SQL` for the independent
DuckDB check.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlens.sources.tables import read_parquet_table

# Anchor dates of the fixture data (fixed values of FIXTURES.md): members
# and orders end on 2001-08-01, coupon claims and events on 2024-01-30.
MEMBER_AS_OF = "2001-08-01"
COUPON_AS_OF = "2024-01-31"


def t_member(spark: SparkSession, root: str) -> DataFrame:
    c = read_parquet_table(spark, root, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("id"),
        F.when(key % 7 == 0, F.lit("null"))
         .otherwise(F.concat(F.lit("138"), F.lpad(key.cast("string"), 8, "0"))).alias("phone"),
        F.when(key % 3 == 0, F.lit(-1)).when(key % 3 == 1, F.lit(1)).otherwise(F.lit(2)).alias("sex"),
        (F.lit(1) + F.col("c_nationkey") % 5).alias("member_channel"),
        F.when(key % 4 == 0, F.lit("null"))
         .otherwise(F.concat(F.lit("wx"), key.cast("string"))).alias("mp_open_id"),
        F.when(key % 5 == 0, F.lit(-1).cast("bigint")).otherwise(key).alias("address_default_id"),
        F.expr("cast('2001-08-01 12:00:00' as timestamp)"
               " - interval '1' day * cast(c_custkey % 60 as int)").alias("create_time"),
    )


def t_order(spark: SparkSession, root: str) -> DataFrame:
    o = read_parquet_table(spark, root, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("member_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(2))
         .when(F.col("o_orderstatus") == "O", F.lit(1)).otherwise(F.lit(3)).alias("order_status"),
        F.col("o_totalprice").alias("origin_price"),
        (F.col("o_totalprice") - F.lit(5.0)).alias("pay_price"),
        F.col("o_orderdate").alias("create_time"),
    )


def t_order_commodity(spark: SparkSession, root: str) -> DataFrame:
    li = read_parquet_table(spark, root, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     (F.lit(1) + F.col("l_partkey") % 19).alias("commodity_id"))


def t_coupon(spark: SparkSession, root: str) -> DataFrame:
    p = read_parquet_table(spark, root, "part")
    return p.select((F.col("p_partkey") + 1).alias("id"),
                    F.col("p_retailprice").alias("coupon_price"))


def t_coupon_member(spark: SparkSession, root: str) -> DataFrame:
    e = read_parquet_table(spark, root, "events")
    return (e.filter(F.col("event_type").isin("signup", "purchase"))
             .select(F.col("event_id").alias("id"),
                     F.col("user_id").alias("member_id"),
                     F.when(F.col("event_type") == "signup", F.lit(1).cast("bigint"))
                      .otherwise(F.lit(2) + F.col("event_id") % 50).alias("coupon_id"),
                     (F.lit(1) + F.col("event_id") % 3).alias("coupon_channel"),
                     F.col("ts").alias("create_time")))


def t_delivery(spark: SparkSession, root: str) -> DataFrame:
    o = read_parquet_table(spark, root, "orders")
    return o.select(
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderdate").alias("pick_time"),
        F.expr("o_orderdate + interval '1' second"
               " * cast(600 + o_orderkey % 3600 as int)").alias("arrive_time"),
    )


def t_feedback(spark: SparkSession, root: str) -> DataFrame:
    e = read_parquet_table(spark, root, "events")
    return (e.filter(F.col("event_type") == "error")
             .select(F.col("event_id").alias("id"),
                     F.col("user_id").alias("member_id"),
                     (F.lit(1) + F.col("event_id") % 4).alias("feedback_type")))


def search_log(spark: SparkSession, root: str) -> DataFrame:
    """Tab-separated search-log lines in a ``value`` column (as ``read.text``)."""
    e = read_parquet_table(spark, root, "events")
    tab = F.lit("\t")
    eid = F.col("event_id")
    line = (F.when(eid % 97 == 0, F.concat(F.col("user_id").cast("string"), tab, F.col("event_type")))
             .when(eid % 89 == 0, F.concat(F.lit("a"), tab, F.lit("b"), tab, tab))
             .otherwise(F.concat(eid.cast("string"), tab, F.col("user_id").cast("string"), tab,
                                 F.col("event_type"), F.lit("_"), (eid % 41).cast("string"),
                                 tab, F.lit("1"))))
    return e.select(line.alias("value"))


_BUILDERS = {
    "t_member": t_member,
    "t_order": t_order,
    "t_order_commodity": t_order_commodity,
    "t_coupon": t_coupon,
    "t_coupon_member": t_coupon_member,
    "t_delivery": t_delivery,
    "t_feedback": t_feedback,
    "search_log": search_log,
}


SHOP_TABLE_NAMES = ("t_member", "t_order", "t_order_commodity", "t_coupon", "t_coupon_member",
                    "t_delivery", "t_feedback")


def load(spark: SparkSession, root: str, *names: str) -> dict[str, DataFrame]:
    """The named fixture views (all of them when no name is given)."""
    wanted = names or tuple(_BUILDERS)
    return {n: _BUILDERS[n](spark, root) for n in wanted}


def view(spark: SparkSession, root: str, name: str) -> DataFrame:
    return _BUILDERS[name](spark, root)


# The same mapping as SQL text (fixed values of FIXTURES.md); it runs on
# Spark and on DuckDB over the driver's tables and feeds the oracle.
VIEW_SQL = {
    "t_member": """select c_custkey as id,
       case when c_custkey % 7 = 0 then 'null' else concat('138', lpad(cast(c_custkey as string), 8, '0')) end as phone,
       case c_custkey % 3 when 0 then -1 when 1 then 1 else 2 end as sex,
       1 + c_nationkey % 5 as member_channel,
       case when c_custkey % 4 = 0 then 'null' else concat('wx', cast(c_custkey as string)) end as mp_open_id,
       case when c_custkey % 5 = 0 then -1 else c_custkey end as address_default_id,
       cast('2001-08-01 12:00:00' as timestamp) - interval '1' day * cast(c_custkey % 60 as int) as create_time
from customer""",
    "t_order": """select o_orderkey as order_id, o_custkey as member_id,
       case o_orderstatus when 'F' then 2 when 'O' then 1 else 3 end as order_status,
       o_totalprice as origin_price, o_totalprice - 5.0 as pay_price, o_orderdate as create_time
from orders""",
    "t_order_commodity": """select l_orderkey as order_id, 1 + l_partkey % 19 as commodity_id from lineitem""",
    "t_coupon": """select p_partkey + 1 as id, p_retailprice as coupon_price from part""",
    "t_coupon_member": """select event_id as id, user_id as member_id,
       case when event_type = 'signup' then 1 else 2 + event_id % 50 end as coupon_id,
       1 + event_id % 3 as coupon_channel, ts as create_time
from events where event_type in ('signup', 'purchase')""",
    "t_delivery": """select o_custkey as member_id, o_orderdate as pick_time,
       o_orderdate + interval '1' second * cast(600 + o_orderkey % 3600 as int) as arrive_time
from orders""",
    "t_feedback": """select event_id as id, user_id as member_id, 1 + event_id % 4 as feedback_type
from events where event_type = 'error'""",
    "search_log": """select case when event_id % 97 = 0 then concat(cast(user_id as string), chr(9), event_type)
            when event_id % 89 = 0 then concat('a', chr(9), 'b', chr(9), chr(9))
            else concat(cast(event_id as string), chr(9), cast(user_id as string), chr(9),
                        event_type, '_', cast(event_id % 41 as string), chr(9), '1') end as value
from events""",
}


@lru_cache(maxsize=None)
def with_views(*names: str) -> str:
    """A ``WITH`` prefix that defines the named views for an oracle query."""
    return "with " + ",\n".join(f"{n} as (\n{VIEW_SQL[n]}\n)" for n in names) + "\n"
