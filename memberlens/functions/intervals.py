"""Elementary intervals: which of many sorted cut points a value lies behind.

The cut points are split at a small, hash-chosen sample of themselves (about
the square root of their number, ``TOPS`` at most). A value finds its part by a
look at the sample, which is a literal of the plan, then joins that one part by
an equi join and looks there. So a value costs one row, however many cuts there
are; the parts are broadcast only if the cuts were counted to be few.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOPS = 1000
FEW = 200_000


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])
    return F.lit(value).cast(kind)


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    return kind


def interval_numbers(cuts: DataFrame, points: bool = False):
    """A function that numbers values by ``cuts``, a DataFrame with the one column ``cut``.

    ``number(rows, value, name)`` adds a column ``name``: how many distinct cuts
    are at most the value (0 below all of them), NULL for a NULL value. With
    ``points`` cuts are intervals of their own: the i-th cut has the number
    2 i - 1, what lies between it and the next one 2 i. Works for every type
    with an order, structs too; the cuts are read once for the sample and once
    in each plan. NULL cuts count for nothing. ``number.cuts`` is how many
    there are.
    """
    kind = _nullable(cuts.schema["cut"].dataType)
    cuts = cuts.where("cut is not null").select(F.col("cut").cast(kind).alias("cut")).distinct()
    tops = [r["cut"] for r in cuts.orderBy(F.xxhash64("cut"), "cut").limit(TOPS).collect()]
    n = len(tops) if len(tops) < TOPS else cuts.count()
    tops = tops[:min(TOPS, math.isqrt(n))]
    bounds = F.array_sort(F.array(*[_literal(t, kind) for t in tops])) if tops else None

    def part(value: Column) -> Column:
        found = F.size(F.filter(bounds, lambda t: t <= value)) if tops else F.lit(0)
        return F.when(value.isNotNull(), found)

    held = (cuts.groupBy(part(F.col("cut")).alias("_part")).agg(F.array_sort(F.collect_list("cut")).alias("_cuts")))
    every = cuts.sparkSession.range(len(tops) + 1).select(F.col("id").cast("int").alias("_part"))
    # The sample has at most TOPS values, so the running count goes over TOPS + 1 rows.
    parts = (every.join(held, "_part", "left").selectExpr(
        "_part", "coalesce(_cuts, cast(array() as array<%s>)) as _cuts" % kind.simpleString(),
        "coalesce(sum(size(_cuts)) over (order by _part rows between unbounded preceding and 1 preceding), 0) as _base"))
    parts = F.broadcast(parts) if n <= FEW else parts

    def number(rows: DataFrame, value: Column, name: str) -> DataFrame:
        placed = rows.withColumn("_value", value.cast(kind)).withColumn("_part", part(F.col("_value")))
        inside = F.size(F.filter("_cuts", lambda c: c <= F.col("_value")))
        found = placed.join(parts, "_part", "left").withColumn("_inside", inside)
        at = F.col("_base") + F.col("_inside")
        if points:
            own = F.try_element_at("_cuts", F.greatest("_inside", F.lit(1))) == F.col("_value")
            at = 2 * at - F.when((F.col("_inside") > 0) & own, 1).otherwise(0)
        return found.withColumn(name, at.cast("long")).drop("_part", "_value", "_cuts", "_base", "_inside")

    number.cuts = n
    return number
