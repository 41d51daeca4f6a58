import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripstrata.session import get_session

    scratch = tempfile.mkdtemp(prefix="run-")
    session = get_session("tests", cores=8, **{
        "spark.checkpoint.dir": scratch, "spark.sql.warehouse.dir": f"{scratch}/warehouse",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
