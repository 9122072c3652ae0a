"""Column-expression builders for the rating formulas.

All of them are plain Catalyst expressions (``when``/arithmetics), so they run
inside whole-stage codegen; no Python UDF is involved anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rating model: the rating scale bounds, the rounding
# applied before ranking / comparing (similarities 10 decimals, every other
# DOUBLE output 9 decimals) and the byte size of one stored similarity.
R_MIN = 1.0
R_MAX = 5.0
SIM_DECIMALS = 10
OUT_DECIMALS = 9
BYTES_PER_VALUE = 8


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scale(x, avg, r_min: float = R_MIN, r_max: float = R_MAX) -> Column:
    """Distance from the user mean to the rating bound on the side of ``x``."""
    x, avg = _col(x), _col(avg)
    return (F.when(x > avg, F.lit(r_max) - avg)
             .when(x < avg, avg - F.lit(r_min))
             .otherwise(F.lit(1.0)))


def normalized_deviation(x, avg, r_min: float = R_MIN, r_max: float = R_MAX) -> Column:
    """(x - avg) / scale(x, avg), a value in [-1, 1]."""
    x, avg = _col(x), _col(avg)
    return (x - avg) / scale(x, avg, r_min, r_max)


def predict_rating(avg, dev, r_min: float = R_MIN, r_max: float = R_MAX) -> Column:
    """Map a user mean and a normalised item deviation back to the rating scale."""
    avg, dev = _col(avg), _col(dev)
    return avg + dev * scale(avg + dev, avg, r_min, r_max)


def jaccard(n_common, n_a, n_b) -> Column:
    n_common, n_a, n_b = _col(n_common), _col(n_a), _col(n_b)
    return n_common.cast("double") / (n_a + n_b - n_common).cast("double")


def abs_error(pred, rating) -> Column:
    return F.abs(_col(pred) - _col(rating))


def weighted_mean(num, den) -> Column:
    """sum(s*d) / sum(|s|) with the "no usable neighbour" case mapped to 0."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def round_sim(x) -> Column:
    return F.round(_col(x), SIM_DECIMALS)


def round_out(x) -> Column:
    return F.round(_col(x), OUT_DECIMALS)
