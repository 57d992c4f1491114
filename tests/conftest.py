import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitalmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CLINICAL = ("id bigint, pregnancies int, glucose double, blood_pressure double, skin_thickness double, insulin double, bmi double, "
            "diabetes_pedigree_function double, age int, outcome int")


@pytest.fixture
def patients(spark):
    """Hand-made rows: ordinary, zeros, NULLs, band edges, extremes."""
    return spark.createDataFrame([
        (1, 4, 152.5, 81.0, 28.0, 0.0, 33.1, 0.55, 47, 1),
        (2, 2, 91.0, 70.0, 22.0, 0.0, 24.7, 0.31, 27, 0),
        (3, 9, 118.0, 0.0, 0.0, 0.0, 36.2, 0.21, 41, 0),
        (4, 7, 129.5, 88.0, 0.0, 0.0, 0.0, 0.44, 58, 1),
        (5, None, None, None, None, None, None, None, None, None),
        (6, 0, 200.0, 180.0, 100.0, 1000.0, 40.0, 2.0, 65, 1),
        (7, 20, 401.0, 251.0, 101.0, 1001.0, 81.0, 3.1, 121, 0),
        (8, 1, 99.99, 79.9, 10.0, 16.0, 18.5, 0.5, 17, 0),
    ], CLINICAL)
