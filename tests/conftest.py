from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def bundle_of(spark):
    """Documents frame from lists of (fullUrl, resource) pairs."""

    def make(*bundles):
        rows = []
        for i, entries in enumerate(bundles):
            body = {"resourceType": "Bundle", "entry": [
                {"fullUrl": url, "resource": res} for url, res in entries
            ]}
            rows.append((i + 1, json.dumps(body)))
        return spark.createDataFrame(rows, "doc_id bigint, json string")

    return make
