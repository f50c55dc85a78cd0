"""Ordered aggregates that stay balanced when one group holds most of the rows.

A plain window over ``partitionBy(group).orderBy(value)`` sends a whole group to one task.
Here every group is cut into value ranges first. The cut points are a fixed-size hash
sample of the rows themselves, so a range holds about the same number of rows however the
values are spread, and the same rows always give the same cut points. Ranges are summed,
the short list of range sums is accumulated, and each range then starts from its own
offset, which enters the range as one extra row ordered first. No join and no cross join
is needed, and the pre-aggregated input is shuffled once and reused by the three readers.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expressions import count_edges, literal_edges, quoted

#: Value ranges per shuffle partition, and the least number of ranges.
RANGES_PER_PARTITION, LEAST_RANGES = 16, 1024


def range_count(df: DataFrame, slots: int | None) -> int:
    """``slots``, or as many ranges as the session's shuffle partitions ask for."""
    if slots is not None:
        return slots
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_RANGES, RANGES_PER_PARTITION * partitions)


def sample_edges(df: DataFrame, order: str, slots: int | None = None) -> DataFrame:
    """One row, one array column: at most ``slots`` sorted sample values of ``order``."""
    slots = range_count(df, slots)
    h = F.xxhash64(*df.columns)
    slot = F.pmod(h, F.lit(slots)).alias("_slot")
    if isinstance(df.schema[order].dataType, (T.StructType, T.StringType)):
        # such values would force a sort-based aggregate over all rows; take the smallest
        # hash per slot instead (at most ``slots`` numbers) and look the rows up by it
        lowest = df.groupBy(slot).agg(F.min(h).alias("_hash")).select("_hash")
        picked = df.withColumn("_hash", h).join(F.broadcast(lowest), "_hash").select(
            F.col(order).alias("_pick"))
    else:
        picked = df.groupBy(slot).agg(F.min_by(order, h).alias("_pick"))
    return picked.agg(F.sort_array(F.collect_set("_pick")).alias("_edges"))


def running_sums(df: DataFrame, keys, order: str, measures, bucket: Column | None = None,
                 slots: int | None = None) -> DataFrame:
    """Add ``cum_<m>`` (sum up to and including the row, ascending ``order`` within
    ``keys``) and ``total_<m>`` for each measure.

    ``order`` must tell rows of one group apart (pre-aggregate, or use a struct with an
    id). ``bucket`` replaces the sampled ranges when the caller knows a monotone and
    evenly filled one, such as a hash prefix.
    """
    keys, slots = list(keys), range_count(df, slots)
    df = df.withColumns({m: F.col(m).cast("long") for m in measures
                         if isinstance(df.schema[m].dataType, T.IntegerType)})
    if bucket is None:
        cut = df.withColumn("_edges", sample_edges(df, order, slots).scalar())
        ranged = cut.withColumn("_range", count_edges(order, "_edges", slots)).drop("_edges")
    else:
        ranged = df.withColumn("_range", bucket)

    sums = ranged.groupBy(*keys, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    group = W.partitionBy(*(keys or [F.lit(0)]))
    before = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        *keys, "_range",
        F.lit(None).cast(df.schema[order].dataType).alias(order),
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).cast(df.schema[m].dataType).alias(m)
          for m in measures],
        *[F.sum(m).over(group).alias(f"_all_{m}") for m in measures],
        F.lit(0).alias("_row"),
    )
    both = offsets.unionByName(ranged.withColumn("_row", F.lit(1)), allowMissingColumns=True)
    upto = (W.partitionBy(*keys, "_range").orderBy("_row", order)
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        both.select(
            *df.columns, "_row",
            *[F.sum(m).over(upto).alias(f"cum_{m}") for m in measures],
            *[F.first(f"_all_{m}").over(upto).alias(f"total_{m}") for m in measures],
        )
        .where(F.col("_row") == 1)
        .drop("_row")
    )


def exact_quantiles(df: DataFrame, keys, value: str, probs) -> DataFrame:
    """Linear-interpolated quantiles per group: ``keys..., p, q``.

    Works on the counts of distinct values, so repeated values cost one row, and only the
    rows that hold a wanted rank leave the ordered step.
    """
    keys = list(keys)
    seen = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counts = (seen.groupBy(*keys, F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("n")))
    ranked = running_sums(counts, keys, "_v", ["n"])
    wanted = F.transform(
        literal_edges(probs),
        lambda p: F.struct(
            p.alias("p"),
            F.floor(p * (F.col("total_n") - 1)).alias("lo"),
            F.ceil(p * (F.col("total_n") - 1)).alias("hi"),
            (p * (F.col("total_n") - 1) - F.floor(p * (F.col("total_n") - 1))).alias("frac"),
        ))
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    hits = ranked.select(
        *keys, "_v", first.alias("_first"), last.alias("_last"),
        F.explode(F.filter(wanted, lambda w: w["lo"].between(first, last)
                           | w["hi"].between(first, last))).alias("w"))
    inside = lambda r: F.col(f"w.{r}").between(F.col("_first"), F.col("_last"))
    return (
        hits.groupBy(*keys, F.col("w.p").alias("p"))
        .agg(F.max(F.when(inside("lo"), F.col("_v"))).alias("_lo"),
             F.max(F.when(inside("hi"), F.col("_v"))).alias("_hi"),
             F.max("w.frac").alias("_frac"))
        .select(*keys, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac"))
                .alias("q"))
    )


def long_format(df: DataFrame, columns, by=(), name="feature", value="value") -> DataFrame:
    """``by..., feature, value`` with one row per column and input row (doubles)."""
    return df.selectExpr(*[f"`{c}`" for c in by],
                         *[f"cast(`{c}` as double) as `{c}`" for c in columns]).unpivot(
        list(by), list(columns), name, value)


def column_quantiles(df: DataFrame, columns, probs, by=(), approx: bool = False,
                     accuracy: int = 10000) -> DataFrame:
    """Quantiles of several columns in one pass: ``by..., feature, p, q``."""
    long = long_format(df, columns, by)
    if not approx:
        return exact_quantiles(long, [*by, "feature"], "value", probs)
    ps = [float(p) for p in probs]
    picked = long.where(F.col("value").isNotNull()).groupBy(*by, "feature").agg(
        F.percentile_approx("value", ps, accuracy).alias("_qs"))
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in ps]).alias("p"), F.col("_qs").alias("q"))
    return picked.select(*by, "feature", F.inline(pairs).alias("p", "q"))


def column_modes(df: DataFrame, columns) -> DataFrame:
    """Most frequent non-null value per column, smallest on ties: ``feature, mode``."""
    long = df.selectExpr(*[f"cast(`{c}` as string) as `{c}`" for c in columns]).unpivot(
        [], list(columns), "feature", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").count()
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct((-F.col("count")).alias("a"), F.col("value").alias("b")))
        .alias("mode"))


def one_row(df: DataFrame, name: str, value: str, columns) -> DataFrame:
    """Turn a short ``name, value`` table into a single struct with one field per name."""
    fields = ", ".join(
        f"max(case when `{name}` = {quoted(c)} then `{value}` end) as `{c}`" for c in columns)
    return df.agg(F.expr(f"struct({fields})").alias("s"))


def numbered(df: DataFrame, order: str, keys=()) -> DataFrame:
    """Add ``_number``, 1, 2, ... by ascending ``order`` within ``keys``; equal values follow a
    hash of the row. Rows are ranked in value ranges, not in one task per group."""
    columns = df.columns
    tagged = df.withColumns({"_at": F.struct(F.col(order).alias("v"), F.xxhash64(*columns).alias("h")),
                             "_one": F.lit(1).cast("long")})
    return running_sums(tagged, list(keys), "_at", ["_one"]).select(
        *columns, F.col("cum__one").alias("_number"))
