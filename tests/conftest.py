import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def rows(frame) -> list[tuple]:
    """A pandas frame's rows, columns by name, numbers and nulls alike."""
    def plain(c, v):
        if pd.api.types.is_scalar(v) and pd.isna(v):
            return "null"
        return str(float(v)) if c in ints or isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind == "f" else str(v)

    cols = sorted(frame.columns)
    ints = [c for c in cols if frame[c].dtype.kind == "f" and frame[c].dropna().eq(frame[c].dropna().round()).all()]
    frame = frame.astype({c: "object" for c in cols})
    out = [tuple(plain(c, v) for c, v in zip(cols, r, strict=True)) for r in frame[cols].itertuples(index=False)]
    return sorted(out)


@pytest.fixture(scope="session")
def same_rows():
    return rows
