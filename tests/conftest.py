import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from daybook.context import checkpoint_dir, configure_session

    scratch = tempfile.mkdtemp(prefix="daybook-tests-")
    s = (SparkSession.builder.master("local[4]").appName("daybook-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
         .config("spark.driver.memory", "4g")
         .config("spark.sql.maxMetadataStringLength", "10000")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure_session(s)
    checkpoint_dir(s, fallback=f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="daybook-t-")


def rows(df, *cols):
    cols = cols or df.columns
    # NULLs sort last within a column; values of one column share a type
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, 0 if v is None else v) for v in t))


def plan_text(df):
    """The formatted physical plan (operator details are not abbreviated there)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
