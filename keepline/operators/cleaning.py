"""Cleaning, imputation and row validation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    KEY_COL, REQUEST_NUMERIC_COLS, REQUEST_RANGES, REQUEST_STRING_COLS,
    REQUIRED_NUMERIC_COLS, YES_NO_COLS,
)
from ..functions.expressions import (
    as_col, numeric_columns, require_columns, string_columns, to_double,
)
from ..functions.ordered import column_modes, column_quantiles, one_row


def coerce_numeric(df: DataFrame, columns=REQUEST_NUMERIC_COLS) -> DataFrame:
    """Turn the listed columns into doubles; unreadable text becomes NULL."""
    return df.withColumns({c: to_double(df, c) for c in columns if c in df.columns})


def drop_null_key(df: DataFrame, key: str = KEY_COL) -> DataFrame:
    return df.dropna(subset=[key])


def yes_no_to_int(df: DataFrame, columns=YES_NO_COLS) -> DataFrame:
    """Yes/No to 1/0 in string columns; any other text becomes NULL."""
    strings = set(string_columns(df))
    return df.withColumns({
        c: F.when(F.col(c) == "Yes", 1).when(F.col(c) == "No", 0)
        for c in columns if c in strings
    })


def _kind(dtype: T.DataType) -> str | None:
    if isinstance(dtype, T.StringType):
        return "categorical"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    return "numeric" if isinstance(dtype, T.NumericType) else None


def profile_null_columns(df: DataFrame) -> DataFrame:
    """``column, kind, has_missing``: columns with a NULL, NaN or blank value."""
    kinds = {f.name: _kind(f.dataType) for f in df.schema.fields if _kind(f.dataType)}

    def missing(c):
        if kinds[c] == "categorical":
            return F.col(c).isNull() | (F.trim(c) == "")
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            return F.col(c).isNull() | F.isnan(c)
        return F.col(c).isNull()

    flags = df.agg(*[F.max(missing(c).cast("int")).alias(c) for c in kinds])
    kind_of = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return flags.unpivot([], list(kinds), "column", "has_missing").select(
        "column", kind_of[F.col("column")].alias("kind"),
        F.coalesce("has_missing", F.lit(0)).alias("has_missing"))


def impute_total_from_monthly(df: DataFrame) -> DataFrame:
    """NULL TotalCharges take the value of MonthlyCharges."""
    df = coerce_numeric(df, ["TotalCharges", "MonthlyCharges"])
    return df.withColumn("TotalCharges", F.coalesce("TotalCharges", "MonthlyCharges"))


def impute_median(df: DataFrame, columns=None) -> DataFrame:
    """Fill NULLs of numeric columns with the exact median of the rest."""
    columns = list(columns or numeric_columns(df))
    if not columns:
        return df
    medians = one_row(column_quantiles(df, columns, [0.5]), "feature", "q", columns)
    return df.withColumn("_fill", medians.scalar()).selectExpr(*[
        f"coalesce(cast(`{c}` as double), _fill.`{c}`) as `{c}`" if c in columns else f"`{c}`"
        for c in df.columns])


def impute_mode(df: DataFrame, columns=None, blank_as_null: bool = False) -> DataFrame:
    """Fill NULLs of string and boolean columns with the most frequent value."""
    columns = list(columns or [f.name for f in df.schema.fields
                               if _kind(f.dataType) in ("categorical", "boolean")])
    if not columns:
        return df
    if blank_as_null:
        df = df.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c in columns
                             if c in string_columns(df)})
    modes = one_row(column_modes(df, columns), "feature", "mode", columns)
    return df.withColumn("_fill", modes.scalar()).selectExpr(*[
        f"coalesce(`{c}`, cast(_fill.`{c}` as {df.schema[c].dataType.simpleString()})) as `{c}`"
        if c in columns else f"`{c}`" for c in df.columns])


def preprocess(df: DataFrame, yes_no_cols=YES_NO_COLS, key: str = KEY_COL,
               blank_as_null: bool = False) -> DataFrame:
    """Coerce TotalCharges, drop NULL keys, map Yes/No, then impute.

    Filling every column equals filling only the columns with gaps, so the profile pass is
    not needed; the fill values reach the rows as two scalar subqueries.
    """
    require_columns(df, [key, "TotalCharges", *yes_no_cols])
    clean = yes_no_to_int(drop_null_key(coerce_numeric(df, ["TotalCharges"]), key), yes_no_cols)
    if "MonthlyCharges" in df.columns:
        clean = impute_total_from_monthly(clean)
    numeric = [c for c in numeric_columns(clean) if c != key]
    text = [f.name for f in clean.schema.fields
            if _kind(f.dataType) in ("categorical", "boolean") and f.name != key]
    return impute_mode(impute_median(clean, numeric), text, blank_as_null)


def select_existing_columns(df: DataFrame, wanted) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def normalize_customer_id(c):
    """Strip white space, then double quotes, then single quotes, from both ends."""
    c = F.regexp_replace(as_col(c), r"^\s+|\s+$", "")
    c = F.regexp_replace(c, r'^"+|"+$', "")
    return F.regexp_replace(c, r"^'+|'+$", "")


def validate_rows(df: DataFrame, ranges=None, required=REQUIRED_NUMERIC_COLS,
                  required_text=REQUEST_STRING_COLS) -> DataFrame:
    """Add ``errors``: an array of reason codes, empty for accepted rows.

    ``missing:<c>`` for an absent required value, ``range:<c>`` for a number outside its
    limits. Split with ``accepted`` and ``rejected``.
    """
    ranges = REQUEST_RANGES if ranges is None else ranges
    require_columns(df, required)
    checks = []
    for c in dict.fromkeys([*required_text, *required, *ranges]):
        if c in df.columns:
            checks.append(F.when(F.col(c).isNull(), F.lit(f"missing:{c}")))
    for c, (lo, hi) in ranges.items():
        if c in df.columns:
            checks.append(F.when(~F.col(c).between(lo, hi), F.lit(f"range:{c}")))
    return df.withColumn("errors", F.filter(F.array(*checks), lambda e: e.isNotNull()))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size("errors") == 0).drop("errors")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.size("errors") > 0)


def to_model_input(df: DataFrame, drop=("customer_id",)) -> DataFrame:
    """Leave out the columns that are not model inputs."""
    return df.drop(*drop)
