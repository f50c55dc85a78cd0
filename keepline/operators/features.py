"""Feature engineering: learned bins and derived columns."""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EPSILON, FLAG_SOURCES, MONTHLY_BINS, TOTAL_BINS
from ..functions.expressions import (
    as_col, literal_edges, require_columns, right_closed_bin, to_double,
)
from ..functions.ordered import column_quantiles
from .cleaning import impute_total_from_monthly


def quantile_edges(df: DataFrame, column_bins: dict, approx: bool = False) -> DataFrame:
    """``feature, edges``: distinct sorted quantile edges per column.

    ``column_bins`` maps a column to its number of bins. A column with a single value v
    gets the edges v-1 and v+1. All columns share one pass.
    """
    probs = sorted({i / q for q in column_bins.values() for i in range(q + 1)})
    wanted = F.lit(False)
    for c, q in column_bins.items():
        wanted = wanted | ((F.col("feature") == c)
                           & F.col("p").isin([i / q for i in range(q + 1)]))
    found = column_quantiles(df, list(column_bins), probs, approx=approx).where(wanted)
    edges = found.groupBy("feature").agg(F.sort_array(F.collect_set("q")).alias("edges"))
    only = F.get("edges", F.lit(0))
    return edges.select("feature", F.when(F.size("edges") < 2, F.array(only - 1, only + 1))
                        .otherwise(F.col("edges")).alias("edges"))


def apply_bins(c, edges):
    """Right-closed bin of a column, NULL to -1; ``edges`` is a list or an array column."""
    if isinstance(edges, (list, tuple)):
        return right_closed_bin(c, literal_edges(edges), len(edges))
    return right_closed_bin(c, edges)


def total_charges_per_month(total="TotalCharges", tenure="tenure", eps: float = EPSILON):
    return as_col(total) / (as_col(tenure) + F.lit(eps))


def ltv(monthly="MonthlyCharges", tenure="tenure"):
    return as_col(monthly) * as_col(tenure)


def one_plus_year_customer(tenure="tenure"):
    return F.coalesce((as_col(tenure) > 12).cast("int"), F.lit(0))


def monthly_charges_squared(monthly="MonthlyCharges"):
    return as_col(monthly) * as_col(monthly)


def service_flags() -> dict:
    """Flag columns; a missing InternetService counts as present, the others as absent."""
    flags = {f"{c}_flag": F.col(c).eqNullSafe("Yes").cast("int") for c in FLAG_SOURCES
             if c != "InternetService"}
    flags["InternetService_flag"] = (~F.col("InternetService").eqNullSafe("No")).cast("int")
    return {f"{c}_flag": flags[f"{c}_flag"] for c in FLAG_SOURCES}


def engineer(df: DataFrame, monthly_edges, total_edges, eps: float = EPSILON) -> DataFrame:
    """Add the 14 derived columns for given bin edges (lists or array columns).

    Unlike fitting, this does not fill TotalCharges: a NULL there gives bin -1.
    """
    require_columns(df, ["tenure", "MonthlyCharges", "TotalCharges", *FLAG_SOURCES])
    num = df.withColumns({c: to_double(df, c) for c in
                          ("tenure", "MonthlyCharges", "TotalCharges")})
    return num.withColumns({
        "TotalChargesPerMonth": total_charges_per_month(eps=eps),
        "ltv": ltv(),
        "MonthlyCharges_group": apply_bins("MonthlyCharges", monthly_edges),
        "TotalCharges_group": apply_bins("TotalCharges", total_edges),
        "onePlusYearCustomer": one_plus_year_customer(),
        "MonthlyCharges_squared": monthly_charges_squared(),
        **service_flags(),
    })


class _FeatureParams(Params):
    monthly_q = Param(Params._dummy(), "monthly_q", "bins of MonthlyCharges",
                      TypeConverters.toInt)
    total_q = Param(Params._dummy(), "total_q", "bins of TotalCharges", TypeConverters.toInt)
    epsilon = Param(Params._dummy(), "epsilon", "added to tenure in the ratio",
                    TypeConverters.toFloat)
    approx = Param(Params._dummy(), "approx", "approximate quantiles",
                   TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(monthly_q=MONTHLY_BINS, total_q=TOTAL_BINS, epsilon=EPSILON,
                         approx=False)


class TelcoFeatures(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the bin edges of both charge columns; the model adds the derived columns."""

    @keyword_only
    def __init__(self, *, monthly_q=MONTHLY_BINS, total_q=TOTAL_BINS, epsilon=EPSILON,
                 approx=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        require_columns(dataset, ["MonthlyCharges", "TotalCharges"])
        filled = impute_total_from_monthly(dataset)
        rows = quantile_edges(filled, {
            "MonthlyCharges": self.getOrDefault("monthly_q"),
            "TotalCharges": self.getOrDefault("total_q"),
        }, self.getOrDefault("approx")).collect()
        edges = {r["feature"]: list(r["edges"]) for r in rows}
        if len(edges) < 2:
            raise ValueError("no numeric values to learn bins from")
        model = TelcoFeaturesModel(monthly_edges=edges["MonthlyCharges"],
                                   total_edges=edges["TotalCharges"])
        return self._copyValues(model)


class TelcoFeaturesModel(Model, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    monthly_edges = Param(Params._dummy(), "monthly_edges", "bin edges of MonthlyCharges",
                          TypeConverters.toListFloat)
    total_edges = Param(Params._dummy(), "total_edges", "bin edges of TotalCharges",
                        TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, monthly_edges=None, total_edges=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if not (self.isSet("monthly_edges") and self.isSet("total_edges")):
            raise RuntimeError("bin edges are not learned yet; fit TelcoFeatures first")
        return engineer(dataset, self.getOrDefault("monthly_edges"),
                        self.getOrDefault("total_edges"), self.getOrDefault("epsilon"))
