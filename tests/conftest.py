import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the library too.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from ebbline.columns import FEATURE_COLUMNS, STRING_FEATURES
from ebbline.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def training(spark):
    """200 labelled rows in which the label follows order_count, with some noise and missing values."""
    rows = []
    for n in range(200):
        features = {}
        for at, name in enumerate(FEATURE_COLUMNS):
            if name in STRING_FEATURES:
                features[name] = [None, "a", "b", "c"][(n + at) % 4]
            else:
                features[name] = None if (n + at) % 9 == 0 else float((n * (at + 3)) % 19)
        features["order_count"] = float(n % 20)
        churn = int(n % 20 < 8) if n % 11 else n % 2
        rows.append((f"u{n:03d}", *features.values(), churn))
    types = ", ".join(f"{name} {'string' if name in STRING_FEATURES else 'double'}" for name in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, f"user_id string, {types}, churn int").cache()
