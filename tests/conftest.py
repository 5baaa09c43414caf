import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from articleloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
