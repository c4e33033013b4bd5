import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
         .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


def rows_of(frame):
    """Rows as sorted tuples of comparable text, columns by name, floats to 6 places."""
    import pandas as pd

    cols = sorted(frame.columns)

    def text(v):
        if v is None or pd.api.types.is_scalar(v) and pd.isna(v):
            return "null"
        if isinstance(v, bool):
            return str(v)
        try:
            return f"{float(v):.5f}".replace("-0.00000", "0.00000")
        except (TypeError, ValueError):
            return str(v)

    return cols, sorted(tuple(text(v) for v in r) for r in frame[cols].itertuples(index=False))
