"""Mixing sources to target weights as a time-varying curriculum.

1. Targets.  Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ...
   and share the total size; a target stops at ``most_passes`` times its
   source's size and the excess is reshared by weight (the water level is
   found from one sorted pass over the source table, a row for each source).
2. Repeats.  In a fixed pseudo-random order of a source's documents, every
   document is taken ``floor(target / size)`` times and a prefix of the order once more,
   so the words taken differ from the target by half a document at most.
3. Positions.  A source's weight over training time t in [0, 1] is a
   piecewise-linear schedule.  Its integral, scaled to the target, is the source's
   cumulative token demand; a copy that starts at demand x gets the position t
   where the demand reaches x (the inverse is closed-form on each segment).
   Range-sorting by t interleaves the sources as the curriculum asks.

Prefix sums over a source never meet in one task: a source is cut into hash
buckets, bucket totals are summed first, and rows are summed within buckets.  With
about sqrt(n) buckets both levels stay small, whatever share one source has.

Rows: null and empty texts have size 0, are taken as often as the rest and
take no words; a null source is a source of its own; rows with equal ids are
mixed each (equal rows are interchangeable); carried columns keep their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arlark.llm.common import SPACE_CLASS, staged

#: Weights given to sources in turn.
WEIGHTS = (1, 2, 3)
#: No document is taken more often.
MOST_PASSES = 3
#: For each weight, (time, weight) knots: light sources early, heavy ones late; each integral is the weight itself.
SCHEDULES = {1: [(0.0, 1.5), (0.5, 1.0), (1.0, 0.5)], 2: [(0.0, 2.0), (1.0, 2.0)], 3: [(0.0, 1.5), (0.5, 3.0), (1.0, 4.5)]}


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+")
    # only the first and the last part can be empty
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int")
            - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    With r = most_passes * size / weight ascending, the sources up to some rank
    are at their limit and the rest share what is left by weight.
    """
    ranked = sizes.withColumn("turn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    table = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.withColumn("weight", F.get(table, F.col("turn") % len(weights)).cast("long")).withColumn(
        "limit", F.col("source_size") * most_passes)
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "turn")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    levels = weighed.withColumn("total", F.sum("source_size").over(Window.partitionBy())).withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("limit").over(earlier), F.lit(0))).cast("double")
        / F.sum("weight").over(later))
    # the first rank whose limit is not below its level: from there on all share by that level
    free = levels.withColumn("fits", F.col("limit") >= F.col("level") * F.col("weight")).withColumn(
        "water", F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(
            by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("limit").cast("double")))
    return free.select("source", "source_size", "weight", target.alias("target"))


def demand_position(weight: Column, share: Column, schedules: dict = SCHEDULES) -> Column:
    """Training time at which a source of this weight has ``share`` (0..1) of its demand behind it."""
    out = F.lit(None).cast("double")
    for w, knots in schedules.items():
        areas = [0.0]
        for (t0, g0), (t1, g1) in zip(knots, knots[1:]):
            areas.append(areas[-1] + (g0 + g1) / 2 * (t1 - t0))
        x = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * areas[-1]
        # the last segment whose start is not beyond x decides
        at = F.lit(None).cast("double")
        for ((t0, g0), (t1, g1)), area in zip(zip(knots, knots[1:]), areas):
            rest, slope = x - area, (g1 - g0) / (t1 - t0)
            inverse = F.lit(t0) + 2 * rest / (F.lit(g0) + F.sqrt(F.greatest(F.lit(g0 * g0) + 2 * slope * rest, F.lit(0.0))))
            at = F.when((x >= area) | at.isNull(), inverse).otherwise(at)
        out = F.when(weight == w, at).otherwise(out)
    return out


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES, schedules: dict = SCHEDULES,
                carry: list[str] = ()) -> DataFrame:
    """One row per document: id, size, source_size, target, repeats, taken, positions (one per copy), first_position.

    ``carry`` packs whole input columns into a struct ``row`` that travels along.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("place"),
                       *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []))
    if not carry:
        base = staged(base, "mix-sizes")
    narrow = base if not carry else staged(base.select("id", "source", "size", "place"), "mix-sizes")
    n = narrow.count()
    digits = max(1, round(math.log(max(n, 1), 16) / 2))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    bucket = F.substring("place", 1, digits)
    sums = narrow.groupBy("source", key.alias("source_key"), bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size"))
    sums = staged(sums, "mix-buckets")
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, most_passes)
    targets = targets.select(key.alias("target_key"), "source_size", "weight", "target")
    before_bucket = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before_bucket), F.lit(0)))
    offsets = offsets.join(targets, F.col("source_key") == F.col("target_key")).select(
        "source_key", "bucket", "offset", "source_size", "weight", "target")

    ties = ["place", "id", "size"]
    before_row = Window.partitionBy("source_key", "bucket").orderBy(*ties).rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("source_key", key).withColumn("bucket", bucket).withColumn(
        "inside", F.coalesce(F.sum("size").over(before_row), F.lit(0)))
    rows = rows.join(offsets, ["source_key", "bucket"])
    start = F.col("offset") + F.col("inside")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("int")
    passes = F.least(passes, F.lit(most_passes))
    rest = F.col("target") - passes * F.col("source_size")
    extra = (passes < most_passes) & (start + F.col("size") / 2 < rest)
    out = rows.withColumn("repeats", passes + extra.cast("int")).withColumn("taken", F.col("size") * F.col("repeats"))
    share = lambda p: F.when(F.col("target") > 0, (p * F.col("source_size") + start + F.col("size") / 2) / F.col("target")).otherwise(F.lit(0.0))  # noqa: E731,E501
    positions = F.when(F.col("repeats") > 0, F.transform(
        F.sequence(F.lit(0), F.col("repeats") - 1),
        lambda p: demand_position(F.col("weight"), share(p), schedules))).otherwise(F.array().cast("array<double>"))
    out = out.withColumn("positions", positions)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "repeats", "taken", "positions",
                      F.get("positions", F.lit(0)).alias("first_position"), *(["row"] if carry else []))


def in_training_order(copies: DataFrame, position_col: str, tie_col: str) -> DataFrame:
    """Rows range-partitioned and sorted by position: files in order are the training sequence."""
    parts = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartitionByRange(parts, position_col, tie_col).sortWithinPartitions(position_col, tie_col)


def training_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                       **options) -> DataFrame:
    """The documents themselves, each as often as it is taken, in training order, with their own columns."""
    mixed = mix_sources(docs, id_col, text_col, source_col, carry=docs.columns, **options)
    copies = mixed.select(F.explode("positions").alias("_position"), F.col(id_col).alias("_tie"), "row")
    return in_training_order(copies, "_position", "_tie").select("row.*")


def oracle_sql() -> str:
    """DuckDB text of the registered query's rows (targets, repeats and words taken)."""
    return r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn, sum(source_size) OVER ()::BIGINT AS total FROM totals),
weighed AS (SELECT *, 1 + turn % 3 AS weight, 3 * source_size AS lim FROM ranked),
levels AS (
  SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim::DOUBLE / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY lim::DOUBLE / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed),
water AS (SELECT level AS w FROM levels WHERE lim >= level * weight ORDER BY lim::DOUBLE / weight, turn LIMIT 1),
targets AS (
  SELECT source, source_size, weight, least(lim::DOUBLE, coalesce((SELECT w FROM water) * weight, lim::DOUBLE)) AS target FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         least(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END, 3)::BIGINT AS passes
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (passes + CASE WHEN passes < 3 AND start + size / 2.0::DOUBLE < target - passes * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed"""
