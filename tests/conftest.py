import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tastegraph.session import get_session

    s = get_session("local[8]", 8, extra_conf={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def ratings_df(spark, rows):
    """rows: {user: {item: rating}} -> DataFrame(user_id, item_id, rating)."""
    data = [(int(u), int(i), float(r)) for u, items in rows.items() for i, r in items.items()]
    return spark.createDataFrame(data, "user_id long, item_id long, rating double")


def pairs_df(spark, pairs):
    return spark.createDataFrame([(int(u), int(i), float(r)) for u, i, r in pairs],
                                 "user_id long, item_id long, rating double")
