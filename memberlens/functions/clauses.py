"""Tag clauses -> Spark Column predicates.

A clause is ``{name, value, type}`` as the tag page sends it. The six types
and how a set of clauses combines follow the search-index bool query the
shop used:

* ``match``, ``rangeBoth``, ``rangeGte``, ``rangeLte`` and ``exists`` are
  *should* clauses; ``notMatch`` is a *must-not* clause;
* a segment is ``(s1 OR s2 OR ...) AND NOT (n1 OR n2 OR ...)``; with no
  should clause every member passes the first part, so selecting two
  tags widens a segment rather than narrowing it;
* ``match`` on an array field (``favGoods``, ``couponTimes``) holds when any
  element equals the value; ``exists`` means not null and, for arrays,
  not empty;
* a NULL field fails every should clause and passes every must-not
  clause (the predicate is coalesced to false before negation);
* values are read by the field's type, so numbers compare as numbers, and
  whole and decimal fields exactly (no way through floating point);
  ``rangeBoth`` takes ``lo-hi``, both inclusive;
* field names resolve case-insensitively (the page says ``feedBack``).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLAUSE_TYPES = ("match", "notMatch", "rangeBoth", "rangeGte", "rangeLte", "exists")
SHOULD_TYPES = ("match", "rangeBoth", "rangeGte", "rangeLte", "exists")


@dataclass(frozen=True)
class Clause:
    name: str
    value: str
    type: str

    @property
    def negated(self) -> bool:
        return self.type == "notMatch"


def parse_clauses(clauses) -> list[Clause]:
    """Clauses from a list of mappings/objects or a JSON array string.

    Unknown types raise ``ValueError``. Repeated clauses are dropped (the
    page keeps the selected tags in a set), first occurrence wins.
    """
    if clauses is None:
        return []
    if isinstance(clauses, (str, bytes)):
        clauses = json.loads(clauses)
        if isinstance(clauses, Mapping) and "selectedTags" in clauses:
            inner = clauses["selectedTags"]
            clauses = json.loads(inner) if isinstance(inner, str) else inner
    out: list[Clause] = []
    seen = set()
    for c in clauses:
        if isinstance(c, Clause):
            clause = c
        elif isinstance(c, Mapping):
            clause = Clause(str(c["name"]), "" if c.get("value") is None else str(c["value"]),
                            str(c["type"]))
        else:
            clause = Clause(str(c.name), "" if c.value is None else str(c.value), str(c.type))
        if clause.type not in CLAUSE_TYPES:
            raise ValueError(f"unknown clause type {clause.type!r}; expected one of {CLAUSE_TYPES}")
        key = (clause.name.lower(), clause.value, clause.type)
        if key not in seen:
            seen.add(key)
            out.append(clause)
    return out


def resolve_field(columns: Iterable[str], name: str) -> str:
    by_lower = {c.lower(): c for c in columns}
    try:
        return by_lower[name.lower()]
    except KeyError:
        raise KeyError(f"no tag field {name!r}; fields are {sorted(by_lower.values())}") from None


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


#: Values of whole and decimal fields are compared exactly, with up to ten decimals.
EXACT = T.DecimalType(38, 10)
_LARGEST = Decimal(10) ** 27      # beyond every whole number and still within EXACT


def exact_number(text: str, what: object) -> Decimal:
    """The finite number a clause value stands for."""
    try:
        x = Decimal(text.strip())
    except InvalidOperation:
        x = Decimal("nan")
    if not x.is_finite():
        raise ValueError(f"clause {what}: {text!r} is not a number")
    return x


def _typed_value(dtype: T.DataType, text: str, clause: Clause) -> Column:
    if not isinstance(dtype, _NUMERIC):
        return F.lit(text).cast(dtype)
    x = exact_number(text, clause)
    if not isinstance(dtype, (*_INTEGRAL, T.DecimalType)):
        return F.lit(float(x))
    if isinstance(dtype, _INTEGRAL) and x == x.to_integral_value() and abs(x) < 2**63:
        return F.lit(int(x)).cast("bigint")
    return F.lit(format(max(-_LARGEST, min(_LARGEST, x)), "f")).cast(EXACT)


def _compare(col: Column, dtype: T.DataType, clause: Clause) -> Column:
    """Predicate of one scalar value (or one array element) against a clause."""
    t, v = clause.type, clause.value
    if t in ("match", "notMatch"):
        return col == _typed_value(dtype, v, clause)
    if t == "rangeGte":
        return col >= _typed_value(dtype, v, clause)
    if t == "rangeLte":
        return col <= _typed_value(dtype, v, clause)
    if t == "rangeBoth":
        if not isinstance(dtype, _NUMERIC):
            raise ValueError(f"clause {clause}: rangeBoth needs a numeric field")
        parts = v.split("-")
        if len(parts) != 2 or not parts[0] or not parts[1]:
            raise ValueError(f"clause {clause}: rangeBoth value must be 'lo-hi' with lo, hi >= 0")
        lo, hi = (_typed_value(dtype, p, clause) for p in parts)
        return (col >= lo) & (col <= hi)
    raise ValueError(f"unknown clause type {t!r}")


def clause_predicate(schema: T.StructType, clause: Clause) -> Column:
    """NULL-free predicate of one clause (the must-not part is *not* negated here)."""
    field = resolve_field(schema.fieldNames(), clause.name)
    dtype = schema[field].dataType
    col = F.col(field)
    if clause.type == "exists":
        pred = col.isNotNull()
        if isinstance(dtype, T.ArrayType):
            pred = pred & (F.size(col) > 0)
        return pred
    if isinstance(dtype, T.ArrayType):
        elem = dtype.elementType
        pred = F.exists(col, lambda x: _compare(x, elem, clause))
    else:
        pred = _compare(col, dtype, clause)
    return F.coalesce(pred, F.lit(False))


def segment_columns(schema: T.StructType, clauses, combine: str = "any") -> tuple[Column, Column]:
    """``(keep, matched)`` for a clause list.

    ``keep`` is the segment predicate; ``matched`` counts the should
    clauses that hold (the deterministic stand-in for relevance order).
    ``combine='all'`` requires every should clause instead of any.
    """
    if combine not in ("any", "all"):
        raise ValueError("combine must be 'any' or 'all'")
    parsed = parse_clauses(clauses)
    should = [clause_predicate(schema, c) for c in parsed if not c.negated]
    must_not = [clause_predicate(schema, c) for c in parsed if c.negated]
    matched = F.lit(0)
    for p in should:
        matched = matched + F.when(p, 1).otherwise(0)
    if should:
        keep = should[0]
        for p in should[1:]:
            keep = (keep | p) if combine == "any" else (keep & p)
    else:
        keep = F.lit(True)
    for p in must_not:
        keep = keep & ~p
    return keep, matched


def segment_filter(df: DataFrame, clauses, combine: str = "any") -> Column:
    return segment_columns(df.schema, clauses, combine)[0]
