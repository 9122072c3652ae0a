"""Rating and personal-list scans, row expectations, dedupe and hold-out split.

Readers declare their schema (no inference pass over the data) and select only
the three rating columns, so Parquet scans prune the rest and text scans
parse only what is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import mark_stored

RATING_COLUMNS = ["user_id", "item_id", "rating"]

# A rating file has user, item, rating and optionally a timestamp that is
# never used. Declaring the fourth column lets FAILFAST accept both layouts.
RATING_TEXT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("item_id", T.LongType(), True),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("ts", T.LongType(), True),
])

PERSONAL_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("rating", T.DoubleType(), True),
])

# Id given to the personal list when it is merged into a rating table; the
# synthetic tables use ids >= 1, so -1 can never collide.
PERSONAL_USER_ID = -1


def read_ratings_text(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Read a delimited rating file (``\\t``, ``::`` or any literal separator)."""
    return (spark.read
            .schema(RATING_TEXT_SCHEMA)
            .option("sep", sep)
            .option("header", "false")
            .option("mode", "FAILFAST")
            .option("ignoreLeadingWhiteSpace", "true")
            .option("ignoreTrailingWhiteSpace", "true")
            .csv(path)
            .select(*RATING_COLUMNS))


def read_ratings_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(F.col("user_id").cast("long"), F.col("item_id").cast("long"),
                     F.col("rating").cast("double"))


def read_personal(spark: SparkSession, path: str) -> DataFrame:
    """Read ``item,title[,rating]`` rows; quoted titles may contain commas.

    A missing third field reads as NULL, i.e. "not rated yet".
    """
    return (spark.read
            .schema(PERSONAL_SCHEMA)
            .option("header", "false")
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path))


def ratings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings derived from the order tables: customer = user, part = item.

    The rating is the quantity band ``ceil(quantity / 10)``; repeated
    (customer, part) purchases fold with ``max`` so every pair is unique.
    Only four columns of the two tables are read.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.max(F.ceil(F.col("l_quantity") / 10)).cast("double").alias("rating")))


def personal_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal list from the part catalogue: every 37th part carries a rating."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_partkey") % 37 == 0, (F.lit(1) + F.col("p_partkey") % 5).cast("double"))
         .alias("rating"))


def is_test_pair(user_col: str = "user_id", item_col: str = "item_id", threshold: str = "33"):
    """Deterministic ~20 % hold-out predicate on md5("user:item").

    Stateless per row, so it needs no shuffle and gives the same split on any
    partitioning and in any engine that has md5.
    """
    key = F.concat(F.col(user_col).cast("string"), F.lit(":"), F.col(item_col).cast("string"))
    return F.substring(F.md5(key), 1, 2) < F.lit(threshold)


def holdout_split(ratings: DataFrame, threshold: str = "33") -> tuple[DataFrame, DataFrame]:
    pred = is_test_pair(threshold=threshold)
    return mark_stored(ratings.filter(~pred), ratings), mark_stored(ratings.filter(pred), ratings)


def with_holdout_flag(ratings: DataFrame, threshold: str = "33") -> DataFrame:
    return ratings.withColumn("is_test", is_test_pair(threshold=threshold))


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return holdout_split(ratings_from_tables(spark, sf_dir))


class ExpectationError(AssertionError):
    pass


def expect_row_count(df: DataFrame, n: int) -> DataFrame:
    """Raise unless ``df`` has exactly ``n`` rows; returns ``df`` to chain."""
    got = df.count()
    if got != n:
        raise ExpectationError(f"expected {n} rows, found {got}")
    return df


def expect_unique(df: DataFrame, cols=("user_id", "item_id")) -> DataFrame:
    """Raise if a key repeats. Distributed: groupBy with partial counts, take(1)."""
    dup = df.groupBy(*cols).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ExpectationError(f"duplicate key {tuple(dup[0][c] for c in cols)} ({dup[0]['count']} rows)")
    return df


def dedupe_ratings(df: DataFrame, how: str = "max") -> DataFrame:
    """Fold repeated (user, item) rows into one rating (max or avg)."""
    agg = {"max": F.max, "avg": F.avg}.get(how)
    if agg is None:
        raise ValueError("how must be 'max' or 'avg'")
    return df.groupBy("user_id", "item_id").agg(agg("rating").cast("double").alias("rating"))


def personal_rated(personal: DataFrame, user_id: int = PERSONAL_USER_ID) -> DataFrame:
    return (personal.filter(F.col("rating").isNotNull())
            .select(F.lit(user_id).cast("long").alias("user_id"), "item_id", "rating"))


def personal_candidates(personal: DataFrame, user_id: int = PERSONAL_USER_ID) -> DataFrame:
    """Catalogue items the personal user has not rated."""
    return (personal.filter(F.col("rating").isNull())
            .select(F.lit(user_id).cast("long").alias("user_id"), "item_id", "title"))


def with_personal(ratings: DataFrame, personal: DataFrame, user_id: int = PERSONAL_USER_ID) -> DataFrame:
    """Corpus ratings plus the rated personal rows (union all, no dedupe)."""
    return mark_stored(ratings.select(*RATING_COLUMNS).unionByName(personal_rated(personal, user_id)), ratings)


def without_rated(candidates: DataFrame, ratings: DataFrame) -> DataFrame:
    """Candidate pairs (user_id, item_id, ...) that ``ratings`` doesn't hold (left-anti join)."""
    return candidates.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
