"""Column expressions used by several operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a strict number parser accepts; Spark's own cast would also take '1.0d'.
_NUMBER = r"^(?i)[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def nan_to_null(c) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def parse_double(c) -> Column:
    """Number in a string column, NULL where the text is not a number."""
    text = F.trim(as_col(c))
    return nan_to_null(F.when(text.rlike(_NUMBER), text.try_cast("double")))


def to_double(df: DataFrame, name: str) -> Column:
    """``name`` as a double with NaN and unreadable text turned into NULL."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_double(name)
    return nan_to_null(F.col(name).cast("double"))


def ratio(num, den, empty=0.0) -> Column:
    """``num / den``; ``empty`` (a number or None) where the denominator is zero."""
    q = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    return q if empty is None else F.coalesce(q, F.lit(float(empty)))


def count_edges(x, edges, most: int | None = None, inclusive: bool = True) -> Column:
    """How many of the ascending ``edges`` (an array column with at most ``most`` entries; any
    number without it) are ``<= x`` (or ``< x``). Binary search, so cost grows with log(most)."""
    x, edges = as_col(x), as_col(edges)
    if most is None:
        deepest = F.floor(F.log2(F.greatest(F.size(edges), F.lit(1)))).cast("int")
        steps = F.transform(F.sequence(deepest, F.lit(0), F.lit(-1)),
                            lambda i: F.pow(F.lit(2), i).cast("int"))
    else:
        powers = range(max(most, 1).bit_length() - 1, -1, -1)
        steps = F.expr("array(" + ", ".join(str(1 << i) for i in powers) + ")")

    def step(pos, s):
        edge = F.get(edges, pos + s - 1)
        return F.when(edge <= x if inclusive else edge < x, pos + s).otherwise(pos)

    return F.coalesce(F.aggregate(steps, F.lit(0), step), F.lit(0))


def right_closed_bin(x, edges, most: int | None = None) -> Column:
    """Bin index for bins ``(a, b]`` with the lowest edge included; values outside the
    edges go to the outer bins and NULL to -1."""
    x, edges = as_col(x), as_col(edges)
    last = F.size(edges) - 2
    raw = F.greatest(count_edges(x, edges, most, inclusive=False) - 1, F.lit(0))
    return F.when(x.isNull(), F.lit(-1)).otherwise(F.least(raw, last)).cast("int")


def left_closed_bin(x, edges, most: int | None = None) -> Column:
    """Bin index for bins ``[a, b)`` with the last bin closed; NULL outside the edges."""
    x, edges = as_col(x), as_col(edges)
    n = F.size(edges)
    inside = (x >= F.get(edges, F.lit(0))) & (x <= F.get(edges, n - 1))
    return F.when(inside, F.least(count_edges(x, edges, most) - 1, n - 2)).cast("int")


def literal_edges(edges) -> Column:
    """Array literal of doubles."""
    return F.expr("array(" + ", ".join(f"{float(e)!r}D" for e in edges) + ")")


def seeded_hash(seed, *parts) -> Column:
    """md5 of ``seed:part:part``; the same text gives the same value in any engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[as_col(p).cast("string") for p in parts])
    return F.md5(text)


def hash_unit(seed, *parts) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of the seeded hash."""
    head = F.conv(F.substring(seeded_hash(seed, *parts), 1, 8), 16, 10)
    return head.cast("double") / F.lit(4294967296.0)


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; adding zero turns -0.0 into 0.0."""
    return df.selectExpr(*[
        f"round(`{f.name}`, {digits}) + 0D as `{f.name}`"
        if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
        for f in df.schema.fields
    ])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require_columns(df: DataFrame, names) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
