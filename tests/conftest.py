import os
import shutil
import tempfile

import pytest

from lakeq.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="lakeq-tests-")
    session = local_session(cores="4", shuffle_partitions=4, memory="3g")
    session.sparkContext.setCheckpointDir(folder)
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
