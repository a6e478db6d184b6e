import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pressroom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4, "4g")


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a column function over a list of one-column inputs."""

    def run(function, inputs, kind="string"):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
        return [r[0] for r in df.repartition(3).select("i", function("x").alias("y")).orderBy("i").select("y").collect()]

    return run
