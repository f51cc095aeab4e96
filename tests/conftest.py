import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from tunewright.session import local_session, ship_package

    s = local_session(8, "tests", spark__sql__shuffle__partitions="4")
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def vectors(spark):
    """Clustered vectors with exact copies, near copies and a zero vector."""
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    near = centres[rng.integers(0, 12, 260)] + rng.normal(size=(260, 16)) * 0.25
    x = np.vstack([near, np.repeat(near[:1], 90, axis=0), np.zeros((2, 16))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(3), x


@pytest.fixture(scope="session")
def seeded():
    import hashlib

    def order(ids, seed=42):
        return sorted(ids, key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())

    return order
