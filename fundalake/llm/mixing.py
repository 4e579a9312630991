"""Mixing sources to target weights that change over the training run.

Each source has a weight schedule over training time, 0 to 1.  Its integral is
the source's weight; the weights share out the total of all sizes, and a source
is asked for at most ``max_epochs`` times its size, the rest going to the
others by weight until none is above (water filling over sources sorted by the
level at which each is full).  Each source's documents stand in a fixed random
order; repeated, they are its stream of tokens.  A copy's place in the stream
is a cumulative demand, and the inverse of the source's integrated schedule
turns it into the training position.

Only DataFrame functions are used.  The running sums over a source are taken in
two levels, over the 4096 buckets of a hash and in each bucket, so that a
source with a third of all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.llm.common import count_words, cut, partitions, row_key

MAX_EPOCHS = 3
BUCKET_HEX = 3
#: In the part pass, documents over a 16th, then those over a 128th of what is wanted are taken before the rest.
LARGE = (16, 128)


def linear(weight: Column, tilt: Column) -> Column:
    """A schedule that runs straight from weight * (1 - tilt) to weight * (1 + tilt); its integral is the weight."""
    return F.array(F.struct(F.lit(0.0).alias("t"), (weight * (1 - tilt)).alias("w")), F.struct(F.lit(1.0).alias("t"), (weight * (1 + tilt)).alias("w")))


def curriculum(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating by rank; the light sources fade out and the heavy ones grow."""
    weight = (F.pmod(rank - 1, F.lit(3)) + 1).cast("double")
    return linear(weight, (weight - 2) / 4)


def segments(knots: Column) -> Column:
    """The pieces between knots (t, w): start, length, weights at both ends, integral before."""
    pieces = F.transform(F.sequence(F.lit(1), F.size(knots) - 1), lambda i: F.struct(F.element_at(knots, i)["t"].alias("t"), (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"]).alias("dt"), F.element_at(knots, i)["w"].alias("w"), F.element_at(knots, i + 1)["w"].alias("v")))
    before = lambda i: F.aggregate(F.slice(pieces, F.lit(1), i), F.lit(0.0), lambda s, p: s + p["dt"] * (p["w"] + p["v"]) / 2)
    return F.transform(pieces, lambda p, i: F.struct(p["t"].alias("t"), p["dt"].alias("dt"), p["w"].alias("w"), p["v"].alias("v"), before(i).alias("c")))


def integral(segs: Column) -> Column:
    return F.aggregate(segs, F.lit(0.0), lambda s, p: s + p["dt"] * (p["w"] + p["v"]) / 2)


def invert(segs: Column, mass: Column) -> Column:
    """The time at which the integrated schedule reaches ``mass``."""
    seg = F.element_at(F.filter(segs, lambda p: (p["c"] <= mass) & (p["dt"] > 0)), -1)
    x = mass - seg["c"]
    slope = (seg["v"] - seg["w"]) / seg["dt"]
    root = seg["w"] + F.sqrt(F.greatest(seg["w"] * seg["w"] + 2 * slope * x, F.lit(0.0)))
    return F.least(seg["t"] + F.when(root > 0, 2 * x / root).otherwise(0.0), F.lit(1.0))


def targets(sizes: DataFrame, schedule: Callable[[Column], Column] = curriculum, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, segs, target) from (source, source_size); a row per source, in one task."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    s = sizes.withColumn("rank", rank).withColumn("segs", segments(schedule(F.col("rank")))).withColumn("weight", integral(F.col("segs")))
    s = s.withColumn("most", (max_epochs * F.col("source_size")).cast("double"))
    by_level = W.orderBy(F.col("most") / F.col("weight"), "rank")
    s = s.withColumn("full", F.coalesce(F.sum("most").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing))).withColumn("total", F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).cast("double"))
    s = s.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # the level rises while the next source is over its limit, and falls after that: the greatest is the right one
    found = F.max("level").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return s.withColumn("target", F.least(F.col("most"), found * F.col("weight"))).select("source", "source_size", "weight", "segs", "target")


def _sized(rows: DataFrame) -> DataFrame:
    """The numbered rows (row, doc_id, source, text) with their size and place in a fixed random order."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = rows.select("row", "doc_id", "source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("sid"), count_words(F.col("text")).alias("size"), key.alias("k"))
    return cut(sized.withColumn("bucket", F.substring("k", 1, BUCKET_HEX)))


def _planned(sized: DataFrame, schedule: Callable[[Column], Column], max_epochs: int) -> DataFrame:
    """(row, doc_id, k, size, source_size, target, passes, more, rest, start, segs, weight): how often each row is taken."""
    per = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), schedule, max_epochs)
    per = per.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    per = cut(per.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")).withColumn("sid", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source"))
    # documents by size against what the part pass wants: 0 the largest, the last the smallest
    cls = F.lit(len(LARGE))
    for i, part in reversed(list(enumerate(LARGE))):
        cls = F.when(F.col("size") * part > F.col("rest"), i).otherwise(cls)
    # dealt by bucket after the join, which AQE can then split at a hot source
    rows = sized.join(per.drop("segs", "weight"), "sid").withColumn("cls", cls).repartition(partitions(sized.sparkSession), "sid", "bucket")
    n_cls = len(LARGE) + 1
    part = [F.col("size"), *[F.when(F.col("cls") == i, F.col("size")).otherwise(0) for i in range(n_cls)]]
    names = ["all", *[f"c{i}" for i in range(n_cls)]]
    sums = rows.groupBy("sid", "bucket").agg(*[F.sum(p).alias(n) for p, n in zip(part, names)])
    before = W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in names], *[F.sum(n).over(W.partitionBy("sid")).alias(f"{n}_total") for n in names[1:]])
    inside = W.partitionBy("sid", "bucket").orderBy("k", "doc_id", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.join(sums, ["sid", "bucket"])
    rows = rows.withColumns({f"{n}_start": F.col(f"{n}_before") + F.coalesce(F.sum(p).over(inside), F.lit(0)) for p, n in zip(part, names)})
    own = F.coalesce(*[F.when(F.col("cls") == i, F.col(f"c{i}_start")) for i in range(n_cls)])
    rows = cut(rows.withColumns({"start": F.col("all_start"), "own": own}).drop(*[f"{n}_{x}" for n in names for x in ("before", "start")]))
    extra = per.select("sid", "segs", "weight")
    for i in range(n_cls):
        if i == 0:
            rows = rows.withColumns({"more": F.lit(False), "got": F.lit(0).cast("long")})
        else:
            got = rows.groupBy("sid").agg(F.sum(F.when(F.col("more"), F.col("size")).otherwise(0)).alias("got"))
            rows = rows.drop("got").join(cut(got.join(extra, "sid") if i + 1 == n_cls else got), "sid")
        later = sum((F.col(f"c{j}_total") for j in range(i + 1, n_cls)), F.col(f"c{i}_total"))
        quota = F.when(later > 0, (F.col("rest") - F.col("got")) * F.col(f"c{i}_total") / later).otherwise(0.0)
        rows = rows.withColumn("more", F.col("more") | ((F.col("cls") == i) & (F.col("size") > 0) & (2 * F.col("own") + F.col("size") <= 2 * quota)))
        if i + 1 < n_cls:
            rows = cut(rows)
    return rows.select("row", "doc_id", "k", "size", "source_size", "target", "passes", "more", "rest", "start", "segs", "weight")


def position(copy: Column) -> Column:
    """Training position, 0 to 1, of a copy (0, 1, ...) of a planned row: the source's integrated schedule, inverted at the cumulative demand before the copy.

    A pass asks for the source's words in its order; what the part pass takes stands within about the first ``rest`` of them.
    """
    demand = F.least((copy * F.col("source_size") + F.col("start")).cast("double"), F.col("target"))
    return F.when(F.col("target") > 0, invert(F.col("segs"), demand / F.col("target") * F.col("weight"))).otherwise(F.lit(0.0))


def _copies(plan: DataFrame) -> DataFrame:
    """The planned rows once for each copy that is taken, with copy and position."""
    copies = F.col("passes") + F.col("more").cast("long")
    each = plan.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    return each.withColumn("position", position(F.col("copy")))


def _in_order(copies: DataFrame) -> DataFrame:
    """Sorted by position.

    Copies that share a position, such as all the empty texts of a source, are told apart by their random key, so that no partition gets them all.
    """
    keys = ("position", "k", "row", "copy")
    return copies.repartitionByRange(partitions(copies.sparkSession), *keys).sortWithinPartitions(*keys)


def _placed(plan: DataFrame) -> DataFrame:
    """(row, doc_id, k, size, copy, position): the copies that are taken, in the order of training, in range partitions."""
    return _in_order(_copies(plan).select("row", "doc_id", "k", "size", "copy", "position"))


def mix(docs: DataFrame, schedule: Callable[[Column], Column] = curriculum, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken, first_position, last_position), a row per row of ``docs``.

    What is taken of a document is counted from the positions that its copies
    have in the training order; both positions are null where it has none.  All
    documents are taken in each full pass of their source.  In the last, part
    pass a source takes documents in its order: the largest up to their share,
    the next up to their share of what is then missing, and so on, so that the
    taken words come within half a small document of the target; a document is
    never cut.

    A null text has size 0, like an empty one; documents of size 0 come with
    the passes and add nothing; a very long text is one document like any
    other; a null source is a source, sorted last; a null doc_id is a doc_id;
    repeated rows are rows like any other, and equal rows may swap places.
    Other columns are ignored; an empty table gives an empty result.
    """
    sized = _sized(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "text"))
    plan = cut(_planned(sized, schedule, max_epochs))
    seen = cut(_placed(plan)).groupBy("row").agg(F.count("*").alias("copies"), F.sum("size").alias("taken"), F.min("position").alias("first_position"), F.max("position").alias("last_position"))
    zero = F.lit(0).cast("long")
    return plan.join(seen, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("copies", zero).alias("copies"), F.coalesce("taken", zero).alias("taken"), "first_position", "last_position")


def ordered(docs: DataFrame, schedule: Callable[[Column], Column] = curriculum, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The training order: ``docs`` once for each copy that is taken, with copy and position, sorted by position in range partitions.

    Cases are treated as mix() does.  Columns of ``docs`` named copy or
    position are replaced; others come along whatever their names.
    """
    names = [c for c in docs.columns if c.lower() not in ("copy", "position")]
    # an id may be null or shared, so rows are named by all that they hold; equal rows are one text and as many plans
    key = row_key(docs, names)
    plan = _planned(_sized(docs.select(key.alias("row"), "doc_id", "source", "text")), schedule, max_epochs)
    each = docs.select(key.alias("row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc")).groupBy("row").agg(F.first("doc").alias("doc"))
    out = _in_order(each.join(_copies(plan).select("row", "k", "copy", "position"), "row"))
    return out.select("doc.*", "copy", "position")
