from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cohort_features.session import build_session, release  # noqa: E402
from cohort_features.sources import schemas  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cohort-tests-")}
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="cohort_features_tests", extra=folder)
    yield s
    release(s)
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cohort-test-")


def _ts(s: str | None):
    if s is None:
        return None
    fmt = "%Y-%m-%d %H:%M" if " " in s else "%Y-%m-%d"
    return dt.datetime.strptime(s, fmt)


# Golden mini-dataset (FIXTURES.md §2).
DIAGNOSES = [(1, "0389"), (1, "25000"), (1, "V3000"), (1, "E8490"), (1, "76519"), (1, None),
             (2, "41401"), (2, "4280"), (3, "77981"), (4, "XYZ")]
ICU_STAYS = [(100, 2.5), (100, 0.75), (101, 1.25), (200, 4.0), (300, 0.5), (400, 3.0)]
ADMISSIONS = [
    (1, 100, "2150-03-01 10:00", None, "SEPSIS", 0),
    (1, 101, "2151-03-02 00:00", None, "CHF", 0),
    (2, 200, "2140-02-28 10:00", "2140-03-04 00:00", "CAD", 1),
    (3, 300, "2130-06-15 08:00", None, "NEWBORN", 0),
    (4, 400, "2160-01-01 00:00", "2160-01-03 00:00", "FALL", 1),
    (5, 500, "2155-05-05 00:00", None, "NONE", 0),
]
PATIENTS = [(1, "2100-03-02", "M"), (2, "2104-02-29", "F"), (3, "2130-06-15", "F"),
            (4, "2073-01-01", "M"), (5, "2100-01-01", "M")]
CHARTS = [
    (1, 678, 98.6), (1, 223761, 100.4), (1, 676, 36.5), (1, 211, 80), (1, 220045, 90), (1, 51, 120),
    (1, 723, 5), (1, 454, 6), (1, 190, 0.4), (1, 223835, 60), (1, 999999, 7),
    (2, 223762, 37.2), (2, 220045, 100), (2, 220045, None), (2, 220179, 110), (2, 220050, 115),
    (2, 184, 4), (2, 3420, 50),
    (3, 678, 0), (3, 676, 36.9), (3, 211, 140), (3, 442, 60), (3, 723, 3), (3, 190, 0.21),
    (4, 211, 70), (4, 51, 130), (4, 723, 5), (4, 190, 0.3),
]
LABS = [
    (1, 51006, "20"), (1, 51006, "30"), (1, 51300, "10.1"), (1, 51301, "12.2"), (1, 50882, "24"),
    (1, 50983, "140"), (1, 50983, "ERROR"), (1, 50822, "4.0"), (1, 50971, "4.5"), (1, 50885, "1.0"),
    (1, 50821, "100"), (1, 50821, "80"), (1, 50816, "21"),
    (2, 51006, "15"), (2, 51301, "8"), (2, 50882, "22"), (2, 950824, "138"), (2, 50971, "3.9"),
    (2, 50885, "0.6"), (2, 50821, "95"),
    (3, 51006, "5"), (3, 51300, "9"), (3, 50882, "20"), (3, 50983, "141"), (3, 50885, "2.0"),
    (3, 50821, "70"),
    (4, 51006, "12"), (4, 51301, "7"), (4, 50882, "25"), (4, 50983, "139"), (4, 50971, "4.1"),
    (4, 50885, "0.9"), (4, 50821, "90"),
]
OUTPUTS = [(1, 40055, "100"), (1, 43175, "50"), (2, 226559, "200"), (3, 40055, "10"), (4, 40055, "60")]


def _num_text(v):
    if v is None:
        return None
    return str(float(v)) if not float(v).is_integer() else str(int(v))


@pytest.fixture(scope="session")
def clinical(spark):
    """The seven clinical roles of the golden mini-dataset, typed by schema."""
    return {
        "diagnoses": spark.createDataFrame(DIAGNOSES, schemas.DIAGNOSES),
        "icu_stays": spark.createDataFrame(ICU_STAYS, schemas.ICU_STAYS),
        "admissions": spark.createDataFrame(
            [(s, h, _ts(a), _ts(d), dx, f) for s, h, a, d, dx, f in ADMISSIONS], schemas.ADMISSIONS
        ),
        "patients": spark.createDataFrame([(s, _ts(b), g) for s, b, g in PATIENTS], schemas.PATIENTS),
        "charts": spark.createDataFrame(
            [(s, i, _num_text(v), None if v is None else float(v)) for s, i, v in CHARTS], schemas.CHARTS
        ),
        "labs": spark.createDataFrame(LABS, schemas.LABS),
        "outputs": spark.createDataFrame(OUTPUTS, schemas.OUTPUTS),
    }
