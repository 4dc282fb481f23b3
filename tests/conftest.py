import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartledger.session import local_session  # noqa: E402
from checks.harness import shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    return session
