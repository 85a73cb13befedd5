import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tallyloom.runtime import build_session
    session = build_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks so small that a few hundred rows already need many cells and block pairs."""
    from tallyloom.operators import cluster, neighbors
    monkeypatch.setattr(neighbors, "BLOCK", 16)
    monkeypatch.setattr(neighbors, "CELL_ROWS", 8)
    monkeypatch.setattr(neighbors, "MOST_TOUCHED", 1.0)
    monkeypatch.setattr(cluster, "BLOCK", 16)
