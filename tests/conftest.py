import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexiquarry.session import local_session, ship

    session = local_session("tests", 4, "4g", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()
