"""The stay cohort: admissions x stays x patients x diagnosis-chapter counts.

Join order is chosen for scale. Everything keyed by subject (patients, code
counts, measures) is unique per subject, so those tables are joined to each
other first on their shared hash partitioning. Admissions meet stays on narrow
rows (five columns), and the wide subject table is attached last, once.

The last join is where a hot subject (a third of all stays) lands. A sketch of
the keys (``hotkeys``) finds such subjects; only they are salted, each to as
many tasks as its stays need, and only their rows of the subject table are
repeated; both inputs of that join are plain shuffles, so AQE can split further.
Without hot subjects the stays join the subject table on the partitioning it
has, without another shuffle of it. Nothing is written; counts and sketches, each
over one column, are the only jobs that run while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.functions.catalog import CODE_COUNT_COLUMNS
from cohort_features.functions.expressions import age_years, binary_code, code_group
from cohort_features.operators.hotkeys import ROWS_PER_TASK, hot_keys, spread_join
from cohort_features.operators.measures import chapter_counts

STAY_COLUMNS = ("subject_id", "hadm_id", "gender", "los", "age", "expire_flag")


def code_counts(
    diagnoses: DataFrame, subject_col: str = "subject_id", code_col: str = "icd9_code"
) -> DataFrame:
    """How many of a subject's codes fall in each of the 20 chapters (E1 + A4).

    Rows with a NULL code are dropped first (P7); codes outside every chapter
    count nowhere, but their subject is kept with zeros. Twenty ``count_if``
    columns in one partial/final aggregate replace collecting each subject's
    list of chapters: nothing per subject is ever held as a list.
    """
    grouped = diagnoses.dropna(subset=[code_col]).select(
        subject_col, code_group(F.col(code_col)).alias("_group")
    )
    return grouped.groupBy(subject_col).agg(*chapter_counts("_group"))


def collect_codes(
    df: DataFrame, key: str, value: str, codes_out: str = "codes", counts_out: str = "counts"
) -> DataFrame:
    """Each key's non-NULL values as a sorted multiset (A3): the distinct
    values in ``codes_out`` and how often each occurs in ``counts_out``.

    The rows are first counted per (key, value) with map-side combining, so
    what is gathered per key is bounded by the value vocabulary, not by the
    key's row count: a key holding a third of the table still yields one
    short list.
    """
    cells = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    pairs = cells.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_n").alias("n")))).alias("_p")
    )
    return pairs.select(key, F.col("_p.v").alias(codes_out), F.col("_p.n").alias(counts_out))


def subject_table(
    patients: DataFrame,
    diagnoses: DataFrame | None,
    extra: DataFrame | None = None,
    subject_col: str = "subject_id",
) -> DataFrame:
    """Per-subject attributes: birth date, sex code input, chapter counts and,
    optionally, per-subject measures (all unique per subject). ``diagnoses``
    is None when ``extra`` already holds the chapter counts."""
    subj = patients.select(subject_col, "dob", "gender")
    if diagnoses is not None:
        subj = subj.join(code_counts(diagnoses, subject_col), on=subject_col, how="inner")
    if extra is not None:
        subj = subj.join(extra, on=subject_col, how="inner")
    return subj


def hot_subjects(admissions: DataFrame, icu_stays: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> dict:
    """{subject: stays, about} of the subjects with over ``rows_per_task``
    stays, from one column of each table and no join: those with many
    admissions, and those of an admission with many stays."""
    stays = icu_stays.count()
    if stays <= rows_per_task:
        return {}
    each = stays / max(admissions.count(), 1)  # stays of an admission, on average
    hot = hot_keys(admissions, "subject_id", rows_per_task, each)
    full = hot_keys(icu_stays, "hadm_id", rows_per_task)
    if full:
        for r in admissions.where(F.col("hadm_id").isin(list(full))).select("subject_id", "hadm_id").collect():
            if r["subject_id"] is not None:
                hot[r["subject_id"]] = hot.get(r["subject_id"], 0) + full[r["hadm_id"]]
    return hot


def stay_table(admissions: DataFrame, icu_stays: DataFrame) -> DataFrame:
    """Admissions x ICU stays on the admission key (J1): one row per stay."""
    adm = admissions.select("subject_id", "hadm_id", "admittime", "hospital_expire_flag")
    return adm.join(icu_stays.select("hadm_id", "los"), on="hadm_id", how="inner")


def cohort_join(admissions: DataFrame, icu_stays: DataFrame, patients: DataFrame) -> DataFrame:
    """J1 + J2: stays with the admission's patient attributes."""
    pats = patients.select("subject_id", "dob", "gender")
    return stay_table(admissions, icu_stays).join(pats, on="subject_id", how="inner")


def stay_cohort(
    admissions: DataFrame,
    icu_stays: DataFrame,
    patients: DataFrame,
    diagnoses: DataFrame | None,
    subject_extra: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per ICU stay with age, sex code, outcome, stay length and the
    subject's 20 chapter counts (J1-J3, E5, E6, A4).

    The outcome is ``hospital_expire_flag`` and the sex code comes from
    ``gender``, each under its own name. ``subject_extra`` (e.g. the subject
    measures) is joined at subject level before the stay-level join.
    """
    subj = subject_table(patients, diagnoses, subject_extra)
    known = ("subject_id", "dob", "gender", *CODE_COUNT_COLUMNS)
    hot = hot_subjects(admissions, icu_stays, rows_per_task)
    joined = spread_join(stay_table(admissions, icu_stays), subj, "subject_id", hot, rows_per_task)
    return joined.select(
        "subject_id",
        "hadm_id",
        *[c for c in subj.columns if c not in known],
        binary_code(F.col("gender")).alias("gender"),
        F.col("los"),
        age_years(F.col("admittime"), F.col("dob")).alias("age"),
        F.col("hospital_expire_flag").cast("int").alias("expire_flag"),
        *CODE_COUNT_COLUMNS,
    )
