"""Descriptive statistics of a table.

Each report reads the table once: per-column figures are computed in one wide aggregate and
turned to long form afterwards, or on the long form with one shuffle for all columns.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import (
    numeric_columns, parse_double, quoted, ratio, string_columns,
)
from ..functions.ordered import column_quantiles, exact_quantiles, long_format

QUARTILES = [0.25, 0.5, 0.75]


def _wide_to_long(df: DataFrame, columns, figures: dict) -> DataFrame:
    """One aggregate over the table, then a row per column.

    ``figures`` maps a name to a function from a quoted column to a SQL aggregate.
    """
    def aggregates(c):
        return ", ".join(f"{sql(f'`{c}`')} as {n}" for n, sql in figures.items())

    wide = df.agg(*[F.expr(f"struct({aggregates(c)})").alias(c) for c in columns])
    rows = ", ".join(
        f"struct({quoted(c)} as `column`, " + ", ".join(f"`{c}`.{n} as {n}" for n in figures)
        + ")" for c in columns)
    return wide.selectExpr(f"inline(array({rows}))")


def describe_numeric(df: DataFrame, columns=None, by=(), approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column (and per ``by``)."""
    columns = list(columns or numeric_columns(df))
    by = list(by)
    moments = long_format(df, columns, by).groupBy(*by, "feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    names = dict(zip(QUARTILES, ("q25", "q50", "q75")))
    q = column_quantiles(df, columns, QUARTILES, by, approx).select(
        *by, "feature", *[F.when(F.col("p") == p, F.col("q")).alias(n)
                          for p, n in names.items()])
    # stacking instead of joining keeps groups with a NULL key
    both = moments.unionByName(q, allowMissingColumns=True)
    figures = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")
    return both.groupBy(*by, "feature").agg(*[F.max(c).alias(c) for c in figures])


def describe_by_target(df: DataFrame, target: str, columns=None) -> DataFrame:
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    return describe_numeric(df, columns, [target])


def describe_schema(df: DataFrame) -> DataFrame:
    """Column name, type and number of non-null values."""
    types = {f"`{f.name}`": f.dataType.simpleString() for f in df.schema.fields}
    return _wide_to_long(df, df.columns, {
        "dtype": lambda c: f"max({quoted(types[c])})",
        "non_null": lambda c: f"count({c})",
    })


def _missing(df: DataFrame):
    """SQL test per quoted column: NULL, empty, or a single space (longer blanks do not
    count here)."""
    strings = {f"`{c}`" for c in string_columns(df)}
    return lambda c: (f"({c} is null or {c} in ('', ' '))" if c in strings
                      else f"({c} is null)")


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and share in percent (two decimals) per column."""
    missing = _missing(df)
    return _wide_to_long(df, df.columns, {
        "missing_count": lambda c: f"count_if({missing(c)})",
        "missing_percentage": lambda c: f"round(coalesce(try_divide(cast(count_if({missing(c)})"
        " as double), cast(count(1) as double)), 0D) * 100, 2)",
    })


def target_in_missing_rows(df: DataFrame, target: str) -> DataFrame:
    """Target counts over the rows with any missing value."""
    missing = _missing(df)
    any_missing = " or ".join(missing(f"`{c}`") for c in df.columns)
    return df.where(any_missing).groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, columns=None) -> DataFrame:
    """``column, level, n`` for all string columns in one shuffle."""
    columns = list(columns or string_columns(df))
    long = df.selectExpr(*[f"cast(`{c}` as string) as `{c}`" for c in columns]).unpivot(
        [], columns, "column", "level")
    return long.where(F.col("level").isNotNull()).groupBy("column", "level").agg(
        F.count(F.lit(1)).alias("n"))


def numeric_histogram(df: DataFrame, columns=None, bins: int = 50) -> DataFrame:
    """Equal-width histogram; only the filled bins are returned."""
    columns = list(columns or numeric_columns(df))
    limits = df.agg(F.struct(*[
        F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                 F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in columns
    ]).alias("s"))
    limit = df.withColumn("_lim", limits.scalar())

    def bin_of(c):
        x, lo, hi = F.col(c).cast("double"), F.col(f"_lim.{c}.lo"), F.col(f"_lim.{c}.hi")
        raw = F.floor(F.try_divide((x - lo) * bins, hi - lo))
        return F.when(x.isNotNull(), F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)))

    binned = limit.select(*[bin_of(c).cast("int").alias(c) for c in columns]).unpivot(
        [], columns, "feature", "bin")
    return binned.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"))


def top_levels_by_median(df: DataFrame, columns, value: str, top: int = 12) -> DataFrame:
    """The most frequent levels of each column with the median of ``value``, ranked by it."""
    columns = list(columns)
    long = df.select(F.col(value).cast("double").alias("_v"),
                     *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        ["_v"], columns, "column", "level").where(F.col("level").isNotNull())
    counts = long.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    pick = F.struct((-F.col("n")).alias("a"), F.col("level").alias("level"))
    ranked = _top_levels(counts.withColumn("_p", pick), top)
    kept = long.join(ranked.select("column", "level"), ["column", "level"], "left_semi")
    medians = exact_quantiles(kept, ["column", "level"], "_v", [0.5]).select(
        "column", "level", F.col("q").alias("median"))
    order = W.partitionBy("column").orderBy("median", "level")
    return ranked.join(medians, ["column", "level"]).select(
        "column", "level", "n", "median",
        F.row_number().over(order).cast("int").alias("position"))


def _top_levels(counts: DataFrame, top: int) -> DataFrame:
    """Keep ``top`` levels per column: slices of the level hash first, then the winners."""
    by_slice = W.partitionBy("column", F.pmod(F.xxhash64("level"), F.lit(256))).orderBy("_p")
    by_column = W.partitionBy("column").orderBy("_p")
    return (
        counts.withColumn("_r", F.row_number().over(by_slice)).where(F.col("_r") <= top)
        .withColumn("_r", F.row_number().over(by_column)).where(F.col("_r") <= top)
        .select("column", "level", "n")
    )


def box_stats(df: DataFrame, columns=None, whisker: float = 1.5) -> DataFrame:
    """Quartiles, the 1.5 IQR fences and the number of values outside them."""
    columns = list(columns or numeric_columns(df))
    q = column_quantiles(df, columns, QUARTILES).groupBy("feature").agg(*[
        F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
        for p, n in zip(QUARTILES, ("q1", "median", "q3"))])
    fences = q.withColumn("lower_fence", F.col("q1") - whisker * (F.col("q3") - F.col("q1"))) \
        .withColumn("upper_fence", F.col("q3") + whisker * (F.col("q3") - F.col("q1")))
    # one row per column: the size is bounded by the number of columns
    long = long_format(df, columns).where(F.col("value").isNotNull())
    x = F.col("value")
    return long.join(F.broadcast(fences), "feature").groupBy(
        "feature", "q1", "median", "q3", "lower_fence", "upper_fence").agg(
        F.count_if((x < F.col("lower_fence")) | (x > F.col("upper_fence"))).alias("outliers"))


def zscore_outliers(df: DataFrame, columns=None, limit: float = 3.0) -> DataFrame:
    """Number of values more than ``limit`` population deviations from the mean."""
    columns = list(columns or numeric_columns(df))
    stats = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns
    ]).alias("s"))
    with_stats = df.withColumn("_st", stats.scalar())
    return _wide_to_long(with_stats, columns, {
        "outliers": lambda c: f"count_if(abs(try_divide({c} - _st.{c}.m, _st.{c}.s)) > {limit})"})


def blank_counts(df: DataFrame) -> DataFrame:
    return _wide_to_long(df, string_columns(df), {
        "blanks": lambda c: f"count_if(trim({c}) = '')"})


def negative_counts(df: DataFrame, columns=None) -> DataFrame:
    return _wide_to_long(df, list(columns or numeric_columns(df)), {
        "negatives": lambda c: f"count_if({c} < 0)"})


def cardinality_report(df: DataFrame, columns=None, limit: int = 10,
                       approx: bool = False) -> DataFrame:
    """Distinct levels per string column and whether there are more than ``limit``.

    Exact counts come from a distributed distinct over (column, level), not from one set
    per column.
    """
    columns = list(columns or string_columns(df))
    if approx:
        counts = _wide_to_long(df, columns, {
            "levels": lambda c: f"approx_count_distinct({c})"})
    else:
        counts = value_counts(df, columns).groupBy("column").agg(
            F.count(F.lit(1)).alias("levels"))
    return counts.withColumn("too_many", (F.col("levels") > limit).cast("int"))


def consistency_rules(df: DataFrame) -> DataFrame:
    """Violations of the three value rules."""
    total = (parse_double("TotalCharges") if "TotalCharges" in string_columns(df)
             else F.col("TotalCharges"))
    rules = {
        "tenure_negative": F.col("tenure") < 0,
        "monthly_not_positive": F.col("MonthlyCharges") <= 0,
        "total_not_numeric": total.isNull(),
    }
    return df.agg(*[F.count_if(r).alias(n) for n, r in rules.items()]).unpivot(
        [], list(rules), "rule", "violations")


def distribution_shape(df: DataFrame, columns=None) -> DataFrame:
    """Mean, population skewness, excess kurtosis and a label."""
    columns = list(columns or numeric_columns(df))
    shape = _wide_to_long(df, columns, {
        "mean": lambda c: f"avg({c})",
        "skew": lambda c: f"skewness({c})",
        "kurtosis": lambda c: f"kurtosis({c})",
    })
    return shape.withColumn("shape", F.when(F.abs("skew") < 0.5, "normal")
                            .when(F.col("skew") > 0, "right").otherwise("left"))


def target_correlation(df: DataFrame, target: str, yes_no_cols, category_levels: dict,
                       numeric) -> DataFrame:
    """Pearson r of each encoded column with the target, one pass over the table.

    ``category_levels`` maps a column to its sorted levels; the first one is left out, as
    in dummy coding with a dropped reference level.
    """
    def yn(c):
        if c in string_columns(df):
            return F.when(F.col(c) == "Yes", 1.0).when(F.col(c) == "No", 0.0)
        return F.col(c).cast("double")

    y = yn(target)
    encoded = {c: yn(c) for c in yes_no_cols if c != target}
    encoded.update({c: F.col(c).cast("double") for c in numeric})
    for c, levels in category_levels.items():
        for level in sorted(levels)[1:]:
            encoded[f"{c}_{level}"] = (F.col(c).eqNullSafe(level)).cast("double")
    wide = df.agg(*[F.corr(e, y).alias(n.replace(".", "_")) for n, e in encoded.items()])
    return wide.unpivot([], wide.columns, "feature", "r")


def category_levels(df: DataFrame, columns, limit: int = 1000) -> dict:
    """Sorted levels of the listed columns, read once to the driver.

    The levels become columns of the encoded table, so their number must be small; more
    than ``limit`` levels in a column raise.
    """
    counts = value_counts(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.max("column").alias("c"))
    sizes = {r["column"]: r["n"] for r in counts.collect()}
    wide = [c for c in columns if sizes.get(c, 0) > limit]
    if wide:
        raise ValueError(f"too many levels to encode: {wide}")
    found: dict = {c: [] for c in columns}
    for r in value_counts(df, columns).select("column", "level").collect():
        found[r["column"]].append(r["level"])
    return {c: sorted(v) for c, v in found.items()}


def churn_rate_by_category(df: DataFrame, column: str, target: str) -> DataFrame:
    """Share of each target value within the levels of a column, percent, two decimals."""
    counts = df.groupBy(F.col(column).alias("level"), F.col(target).alias("target")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.round(
        ratio("n", F.sum("n").over(W.partitionBy("level"))) * 100, 2))

