import os
import sys
import tempfile

import pytest
from pyspark import cloudpickle

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import flaky  # noqa: E402

# workers don't have the tests' folder on their path
cloudpickle.register_pickle_by_value(flaky)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dossier.session import get_spark
    os.environ.setdefault("DOSSIER_DRIVER_MEMORY", "3g")
    s = get_spark("local[4]", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="test-stages-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
