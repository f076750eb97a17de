import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    top = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").config("spark.checkpoint.dir", f"file://{top}/shared")
        .config("spark.local.dir", str(top)).config("spark.sql.warehouse.dir", f"{top}/warehouse").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows_of(frame) -> list:
    """Rows of a pandas frame, columns by name, for comparing without order."""
    import pandas as pd

    def plain(x):
        if isinstance(x, float) and x == int(x):
            return int(x)
        return x

    cols = sorted(frame.columns)
    return sorted((tuple(None if pd.isna(x) else plain(x) for x in r) for r in frame[cols].astype(object).values.tolist()), key=str)
