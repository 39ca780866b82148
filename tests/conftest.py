from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loomstat import build_session

    session = build_session(
        "tests", master="local[8]", shuffle_partitions=4,
        conf={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from loomstat.plans.inputs import Inputs

    return Inputs(spark, SF_DIR)


@pytest.fixture(scope="session")
def make_graph(spark):
    """A graph from edge pairs, with further vertices that have no edges."""
    from loomstat.graph.model import PropertyGraph

    def make(edges, isolated=()):
        ids = sorted({v for edge in edges for v in edge} | set(isolated))
        vertices = spark.createDataFrame([(v,) for v in ids], "id string")
        rows = [(a, b, "cites") for a, b in edges]
        return PropertyGraph(vertices, spark.createDataFrame(rows, "src string, dst string, rel_type string"))

    return make
