from .exprs import (  # noqa: F401
    BYTES_PER_VALUE,
    OUT_DECIMALS,
    R_MAX,
    R_MIN,
    SIM_DECIMALS,
    abs_error,
    jaccard,
    normalized_deviation,
    predict_rating,
    round_out,
    round_sim,
    scale,
    weighted_mean,
)
