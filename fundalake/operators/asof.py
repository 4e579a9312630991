"""As-of join: each left row with the nearest right row of its key, backwards or forwards in time.

Three plans with one result.  "interval" gives each right row the span up to the
next one and joins on the key with a range condition; it suits few right rows
per key.  "window" unions both sides and carries the last (next) right row over
a sorted window; it is linear when both sides are dense.  "sliced" is for keys
that hold much of the data: the match depends on the key and the date alone, so
the different pairs of these are taken (with partial sums before the shuffle)
and dealt, as are the right rows, by key and slice of time; a window runs inside
each slice, and a second, small level carries each slice's last right row into
the slices after it.  The left rows then meet their pair in an equi-join, whose
large keys AQE splits.  No row is copied, and no task needs a key's rows together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundalake.operators.windows import dedup_by


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, direction: str = "backward", tie: Sequence[Column] = (), plan: str = "interval", match: str = "_match", width: float = 31) -> DataFrame:
    """``left`` with a struct column ``match`` of the right row's other columns (null without a match).

    Ties on the right date go to the first row by ``tie``.  Right rows with a
    null key or date never match.  The match is the nearest row even if some of
    its values are null.  ``width``: a slice of the sliced plan, in days for dates
    and timestamps, in their own units for numbers.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    values = [c for c in right.columns if c not in by]
    right = dedup_by(right.filter(F.col(right_on).isNotNull()), [*by, right_on], list(tie) or [F.lit(1)])
    packed = right.select(*by, F.col(right_on).alias("_at"), F.struct(*values).alias(match))
    if plan == "interval":
        w = W.partitionBy(*by).orderBy("_at")
        step = F.lead("_at") if direction == "backward" else F.lag("_at")
        spans = packed.withColumn("_next", step.over(w)).withColumnsRenamed({k: f"_r_{k}" for k in by})
        on = [F.col(k) == F.col(f"_r_{k}") for k in by]
        if direction == "backward":
            on += [F.col(left_on) >= F.col("_at"), F.col("_next").isNull() | (F.col(left_on) < F.col("_next"))]
        else:
            on += [F.col(left_on) <= F.col("_at"), F.col("_next").isNull() | (F.col(left_on) > F.col("_next"))]
        return left.join(spans, on, "left").select(*left.columns, match)
    if plan == "sliced":
        return _sliced(left, packed, by, left_on, direction, match, width)
    if plan != "window":
        raise ValueError(plan)
    rest = F.struct(*[c for c in left.columns if c not in by])
    kind = packed.schema[match].dataType
    ours = left.select(*by, F.col(left_on).alias("_at"), rest.alias("_left"), F.lit(None).cast(kind).alias(match))
    theirs = packed.select(*by, "_at", F.lit(None).cast(ours.schema["_left"].dataType).alias("_left"), match)
    right_first = F.col("_left").isNotNull().asc()
    order = [F.col("_at").asc_nulls_first(), right_first] if direction == "backward" else [F.col("_at").desc_nulls_first(), right_first]
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = F.last(match, ignorenulls=True).over(w)
    keyed = [F.when(F.col(k).isNull(), True) for k in by]
    both = ours.unionByName(theirs).withColumn(match, F.when(F.coalesce(*keyed, F.col("_at").isNull()), F.lit(None)).otherwise(found))
    return both.filter("_left is not null").select(*[F.col(k) if k in by else F.col(f"_left.{k}").alias(k) for k in left.columns], match)


def _slice(at: Column, kind: T.DataType, width: float) -> Column:
    if isinstance(kind, T.DateType):
        at = F.unix_date(at)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        at = F.unix_micros(at.cast("timestamp")) / 86_400e6
    return F.floor(at / width)


def _sliced(left: DataFrame, packed: DataFrame, by: Sequence[str], left_on: str, direction: str, match: str, width: float) -> DataFrame:
    ahead = direction == "forward"
    order = lambda c: F.col(c).desc() if ahead else F.col(c).asc()
    none = F.lit(None).cast(packed.schema[match].dataType)
    pairs = left.select(*by, F.col(left_on).alias("_at")).na.drop().distinct()
    cut = lambda df: df.withColumn("_slice", _slice(F.col("_at"), df.schema["_at"].dataType, width))
    ours, theirs = cut(pairs).withColumns({match: none, "_ours": F.lit(1)}), cut(packed.na.drop(subset=[*by, "_at"])).withColumn("_ours", F.lit(0))
    inside = W.partitionBy(*by, "_slice").orderBy(order("_at"), "_ours").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = ours.unionByName(theirs).withColumn("_in", F.last(match, ignorenulls=True).over(inside)).filter("_ours = 1").drop(match, "_ours")
    edge = (F.min_by if ahead else F.max_by)(match, "_at")
    slices = ours.select(*by, "_slice").distinct().withColumn(match, none).unionByName(theirs.groupBy(*by, "_slice").agg(edge.alias(match)))
    slices = slices.groupBy(*by, "_slice").agg(F.first(match, ignorenulls=True).alias(match))
    earlier = W.partitionBy(*by).orderBy(order("_slice")).rowsBetween(W.unboundedPreceding, -1)
    carried = slices.withColumn("_carried", F.last(match, ignorenulls=True).over(earlier)).drop(match)
    known = found.join(carried, [*by, "_slice"]).select(*[F.col(k).alias(f"_r_{k}") for k in by], "_at", F.coalesce("_in", "_carried").alias(match))
    on = [F.col(k) == F.col(f"_r_{k}") for k in by] + [F.col(left_on) == F.col("_at")]
    return left.join(known, on, "left").select(*left.columns, match)
