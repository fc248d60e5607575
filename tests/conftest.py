import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stockgap.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="stockgap-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield s


@pytest.fixture(scope="session")
def planted(spark, tmp_path_factory):
    """The planted-anomaly warehouse, loaded from CSV files."""
    from fixtures import write_planted_csvs
    from stockgap.sources.reference import bind_reference_tables, load_reference_csvs
    folder = tmp_path_factory.mktemp("planted")
    write_planted_csvs(str(folder))
    return bind_reference_tables(load_reference_csvs(spark, str(folder)))
