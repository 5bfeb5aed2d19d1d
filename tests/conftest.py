import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    # Tables here are tiny: compiling a stage would take longer than running it.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()
