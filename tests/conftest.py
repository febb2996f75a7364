import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weirstone.layout import Lake  # noqa: E402
from weirstone.session import local_session  # noqa: E402

SAMPLE = os.environ.get("WEIRSTONE_SAMPLE", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("weirstone-tests", cores="4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def sample():
    return SAMPLE


@pytest.fixture(scope="session")
def golden(spark):
    """A lake of the sample feeds, built once, and the outcome of its run; gates are recorded, not enforced."""
    from weirstone.bindings.workspace import Workspace
    from weirstone.plans.pipeline import run
    from weirstone.sources.changes import ingest, require_all_loaded

    workspace = Workspace(spark, SAMPLE)
    lake = Lake(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    require_all_loaded(ingest(spark, lake, workspace.read_topic, parallel=4))
    return lake, run(spark, lake, enforce_gates=False)
