"""Explicit schemas of the seven clinical inputs (never inferred).

Inference costs an extra pass over the data and makes types depend on the
content (an all-digit code column would become an integer and lose leading
zeros); these schemas fix what each operator requires.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


DIAGNOSES = _schema(("subject_id", LongType()), ("icd9_code", StringType()))
ICU_STAYS = _schema(("hadm_id", LongType()), ("los", DoubleType()))
ADMISSIONS = _schema(
    ("subject_id", LongType()),
    ("hadm_id", LongType()),
    ("admittime", TimestampType()),
    ("deathtime", TimestampType()),
    ("diagnosis", StringType()),
    ("hospital_expire_flag", IntegerType()),
)
PATIENTS = _schema(("subject_id", LongType()), ("dob", TimestampType()), ("gender", StringType()))
CHARTS = _schema(
    ("subject_id", LongType()),
    ("itemid", IntegerType()),
    ("value", StringType()),
    ("valuenum", DoubleType()),
)
LABS = _schema(("subject_id", LongType()), ("itemid", IntegerType()), ("value", StringType()))
OUTPUTS = _schema(("subject_id", LongType()), ("itemid", IntegerType()), ("value", StringType()))

CLINICAL_SCHEMAS: dict[str, StructType] = {
    "diagnoses": DIAGNOSES,
    "icu_stays": ICU_STAYS,
    "admissions": ADMISSIONS,
    "patients": PATIENTS,
    "charts": CHARTS,
    "labs": LABS,
    "outputs": OUTPUTS,
}
