import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    made = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not Path(path).exists():
        pytest.skip("no driver tables here")
    return path


@pytest.fixture(scope="session")
def oracle(sf_dir):
    """Rows of SQL over the driver's tables, as sorted lists of text."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")

    def rows(sql):
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        return names, got.fetchall()

    return rows


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(str(r[i]) for i in order) for r in rows])


@pytest.fixture(scope="session")
def same_rows():
    def check(df, expected):
        names, rows = expected
        assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, rows)

    return check
