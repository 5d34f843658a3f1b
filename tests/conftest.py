import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return con


def rows_of(frame):
    """Rows as sorted tuples, columns by name."""
    names = sorted(frame.columns)
    return sort([tuple(r[n] for n in names) for r in frame.collect()])


def oracle_rows(con, sql):
    found = con.sql(sql)
    names = list(found.columns)
    order = [names.index(n) for n in sorted(names)]
    return sorted(names), sort([tuple(r[i] for i in order) for r in found.fetchall()])


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
