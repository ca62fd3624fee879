import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cuvee.runtime import local_session

    session = local_session("tests", cpus=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="cuvee-test-")


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def spread(df, n):
    """The same rows in another order and another number of partitions."""
    from pyspark.sql import functions as F

    return df.orderBy(F.xxhash64(*df.columns, F.lit(n))).repartition(n)
