from .ratings import (  # noqa: F401
    PERSONAL_USER_ID,
    ExpectationError,
    dedupe_ratings,
    expect_row_count,
    expect_unique,
    holdout_split,
    is_test_pair,
    personal_candidates,
    personal_from_part,
    personal_rated,
    ratings_from_tables,
    read_personal,
    read_ratings_parquet,
    read_ratings_text,
    train_test,
    with_holdout_flag,
    with_personal,
)
from .sinks import metric_rows, nested_json, union_metrics, write_metrics  # noqa: F401
