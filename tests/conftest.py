import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

from pairloom.plans.fixtures import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def rows(names, found):
    """Rows with columns in order of their names, comparable between engines."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda v: f"{v:.9g}" if isinstance(v, float) else str(int(v)) if isinstance(v, bool) else str(v)
    return sorted([cell(r[i]) for i in order] for r in found)


def same_rows(df, c, sql):
    r = c.execute(sql)
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, r.fetchall())
