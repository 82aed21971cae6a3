import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from cohortlens.session import DEFAULT_CONF, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("cohortlens-tests")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlens-test-ckpt-"))
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_null_safe)


def _null_safe(t):
    return tuple((v is not None, v if v is not None else 0) for v in t)
