"""The measurement catalogue: which events make which feature.

Measures are data, not code. A ``Component`` is one averaged slice of one
event table (rows whose item id is in ``items``); a ``Measure`` turns one or
two components (or earlier measures) into an output column. The operators in
``operators.measures`` read this description and build a single conditional
aggregate per event table from it.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Fixed values. These must equal the original clinical definitions for the
# features to mean the same thing; they are stated here as plain data.
# --------------------------------------------------------------------------

# chart item ids (source: charts, value column VALUENUM unless noted)
GLASGOW_COMA_SCALE_ITEMS = (723, 454, 184, 223900, 223901, 220739)
SYSTOLIC_BLOOD_PRESSURE_ITEMS = (51, 442, 455, 6701, 220179, 220050)
HEART_RATE_ITEMS = (211, 220045)
BODY_TEMP_FAHRENHEIT_ITEMS = (678, 223761)
BODY_TEMP_CELSIUS_ITEMS = (676, 223762)
FIO2_FRACTION_ITEMS = (190,)  # VALUE column, already a fraction
FIO2_PERCENT_ITEMS = (223835, 3420, 3422)  # VALUE column, percent -> / 100

# output-event item ids (source: outputs, value column VALUE)
URINE_OUTPUT_ITEMS = (
    40055, 43175, 40069, 40094, 40715, 40473,
    40085, 40057, 40056, 40405, 40428, 40086,
    40096, 40651, 226559, 226560, 226561, 226584,
    226563, 226564, 226565, 226567, 226557, 226558, 227488, 227489,
)

# lab item ids (source: labs, value column VALUE)
SERUM_UREA_NITROGEN_ITEMS = (51006,)
WHITE_BLOOD_CELLS_ITEMS = (51300, 51301)
SERUM_BICARBONATE_ITEMS = (50882,)
SODIUM_ITEMS = (950824, 50983)
POTASSIUM_ITEMS = (50822, 50971)
BILIRUBIN_ITEMS = (50885,)
PAO2_ITEMS = (50821,)

# Diagnosis-code chapters: (first code, last code, chapter) over the integer
# value of the first three characters; letter prefixes map directly. Codes 0
# and 760-779 belong to no chapter and yield NULL.
CODE_GROUP_RANGES = (
    (1, 139, 1),
    (140, 239, 2),
    (240, 279, 3),
    (280, 289, 4),
    (290, 319, 5),
    (320, 389, 6),
    (390, 459, 7),
    (460, 519, 8),
    (520, 579, 9),
    (580, 629, 10),
    (630, 679, 11),
    (680, 709, 12),
    (710, 739, 13),
    (740, 759, 14),
    (780, 789, 15),
    (790, 796, 16),
    (797, 799, 17),
    (800, 999, 18),
)
CODE_GROUP_LETTERS = (("E", 20), ("V", 19))
N_CODE_GROUPS = 20
AGE_CAP_ABOVE = 86  # ages above this are reported as AGE_CAP_VALUE
AGE_CAP_VALUE = 87
MALE_CODE = "M"  # -> 0; anything else, NULL included -> 1

# Feature descriptions (chapter names by chapter number 1..20)
CODE_GROUP_NAMES = (
    "Infectious And Parasitic Diseases",
    "Neoplasms",
    "Endocrine, Nutritional And Metabolic Diseases, And Immunity Disorders",
    "Diseases Of The Blood And Blood-Forming Organs",
    "Mental Disorders",
    "Diseases Of The Nervous System And Sense Organs",
    "Diseases Of The Circulatory System",
    "Diseases Of The Respiratory System",
    "Diseases Of The Digestive System",
    "Diseases Of The Genitourinary System",
    "Complications Of Pregnancy, Childbirth, And The Puerperium",
    "Diseases Of The Skin And Subcutaneous Tissue",
    "Diseases Of The Musculoskeletal System And Connective Tissue",
    "Congenital Anomalies",
    "Symptoms",
    "Nonspecific Abnormal Findings",
    "Ill-Defined And Unknown Causes Of Morbidity And Mortality",
    "Injury And Poisoning",
    "Supplementary Classification Of Factors Influencing Health Status And Contact With Health Services",
    "Supplementary Classification Of External Causes Of Injury And Poisoning",
)
MEASURE_DESCRIPTIONS = (
    ("avg_temp", "Body Temperature"),
    ("avg_heart_rate", "Heart Rate"),
    ("avg_bp", "Blood Pressure"),
    ("avg_coma_scale", "Glasgow Coma Scale"),
    ("avg_urine_output", "Urine Output"),
    ("avg_nitrogen", "Serum Urea Nitrogen Level"),
    ("avg_wbc", "White Blood Cells Count"),
    ("avg_bico", "Serum Bicarbonate Level"),
    ("avg_sodium", "Sodium Level"),
    ("avg_potassium", "Potassium Level"),
    ("avg_bilirubin", "Bilirubin Level"),
    ("pf_ratio", "PaO2 / FiO2 ratio"),
    ("gender", "0 for Male, 1 for Female"),
    ("age", "Patient's Age"),
)
# --------------------------------------------------------------------------


def code_group_column(i: int) -> str:
    """Name of the count column for chapter ``i`` (1-based)."""
    return f"icd9_g{i}"


CODE_COUNT_COLUMNS = tuple(code_group_column(i) for i in range(1, N_CODE_GROUPS + 1))


@dataclass(frozen=True)
class Component:
    """Mean of ``value_col`` over rows of ``source`` whose item is in ``items``.

    ``transform`` is applied per row before averaging: ``None``,
    ``"f_to_c"`` (Fahrenheit to Celsius, 0 treated as missing) or
    ``"percent"`` (divide by 100). ``scale`` declares that the transformed
    values have at most that many decimals, which are then summed exactly
    (see ``expressions.mean``); by default the mean is Spark's ``avg``.
    """

    name: str
    source: str
    items: tuple
    value_col: str = "value"
    transform: str | None = None
    scale: int | None = None


@dataclass(frozen=True)
class Measure:
    """An output (or intermediate) column computed from components.

    kind ``mean``:  the single input's mean, rounded to ``digits`` if given.
    kind ``merge``: both inputs truthy (non-null, non-zero) -> their average,
                    else the first if truthy, else the second.
    kind ``ratio``: first / second, NULL when the second is 0 or NULL.
    ``required`` measures must be non-null for a subject to be kept;
    ``in_vector`` ones enter the model feature vector; ``visible`` ones are
    returned (intermediates such as the merged FiO2 are not).
    """

    name: str
    kind: str
    inputs: tuple[str, ...]
    digits: int | None = 2
    required: bool = True
    in_vector: bool = True
    visible: bool = True


@dataclass(frozen=True)
class MeasureCatalogue:
    components: tuple[Component, ...]
    measures: tuple[Measure, ...]

    def sources(self) -> tuple[str, ...]:
        seen: list[str] = []
        for c in self.components:
            if c.source not in seen:
                seen.append(c.source)
        return tuple(seen)

    def components_of(self, source: str) -> tuple[Component, ...]:
        return tuple(c for c in self.components if c.source == source)

    def visible(self) -> tuple[Measure, ...]:
        return tuple(m for m in self.measures if m.visible)

    def required(self) -> tuple[str, ...]:
        return tuple(m.name for m in self.measures if m.required and m.visible)

    def vector(self) -> tuple[str, ...]:
        return tuple(m.name for m in self.measures if m.in_vector and m.visible)

    def sources_of(self, name: str) -> set[str]:
        """Event tables a component or measure depends on."""
        for c in self.components:
            if c.name == name:
                return {c.source}
        for m in self.measures:
            if m.name == name:
                out: set[str] = set()
                for i in m.inputs:
                    out |= self.sources_of(i)
                return out
        raise KeyError(name)


CLINICAL_CATALOGUE = MeasureCatalogue(
    components=(
        Component("temp_f", "charts", BODY_TEMP_FAHRENHEIT_ITEMS, "valuenum", "f_to_c"),
        Component("temp_c", "charts", BODY_TEMP_CELSIUS_ITEMS, "valuenum"),
        Component("heart_rate", "charts", HEART_RATE_ITEMS, "valuenum"),
        Component("bp", "charts", SYSTOLIC_BLOOD_PRESSURE_ITEMS, "valuenum"),
        Component("coma_scale", "charts", GLASGOW_COMA_SCALE_ITEMS, "valuenum"),
        Component("fio2_fraction", "charts", FIO2_FRACTION_ITEMS, "value"),
        Component("fio2_percent", "charts", FIO2_PERCENT_ITEMS, "value", "percent"),
        Component("urine_output", "outputs", URINE_OUTPUT_ITEMS, "value"),
        Component("nitrogen", "labs", SERUM_UREA_NITROGEN_ITEMS, "value"),
        Component("wbc", "labs", WHITE_BLOOD_CELLS_ITEMS, "value"),
        Component("bico", "labs", SERUM_BICARBONATE_ITEMS, "value"),
        Component("sodium", "labs", SODIUM_ITEMS, "value"),
        Component("potassium", "labs", POTASSIUM_ITEMS, "value"),
        Component("bilirubin", "labs", BILIRUBIN_ITEMS, "value"),
        Component("po2", "labs", PAO2_ITEMS, "value"),
    ),
    measures=(
        Measure("avg_temp", "merge", ("temp_f", "temp_c")),
        Measure("avg_heart_rate", "mean", ("heart_rate",)),
        Measure("avg_bp", "mean", ("bp",)),
        Measure("avg_coma_scale", "mean", ("coma_scale",)),
        Measure("avg_urine_output", "mean", ("urine_output",)),
        Measure("avg_nitrogen", "mean", ("nitrogen",)),
        Measure("avg_wbc", "mean", ("wbc",)),
        Measure("avg_bico", "mean", ("bico",)),
        Measure("avg_sodium", "mean", ("sodium",)),
        # required (a patient without potassium is dropped) but not a model input
        Measure("avg_potassium", "mean", ("potassium",), in_vector=False),
        Measure("avg_bilirubin", "mean", ("bilirubin",)),
        Measure("avg_fio2", "merge", ("fio2_fraction", "fio2_percent"), visible=False),
        Measure("pf_ratio", "ratio", ("po2", "avg_fio2")),
    ),
)

# Feature-vector layouts (order matters: it is the model's input order).
CLASSIFICATION_LABEL = "expire_flag"
REGRESSION_LABEL = "los"


def vector_columns(catalogue: MeasureCatalogue, task: str) -> list[str]:
    """Ordered model inputs: measures, sex code, [length of stay], age, 20 counts."""
    cols = list(catalogue.vector()) + ["gender"]
    if task == "classification":
        cols.append("los")
    elif task != "regression":
        raise ValueError(f"unknown task {task!r}")
    cols.append("age")
    return cols + list(CODE_COUNT_COLUMNS)


def feature_descriptions() -> list[tuple[str, str]]:
    """(feature, description) for every column that can enter a vector."""
    rows = list(MEASURE_DESCRIPTIONS)
    rows.append(("los", "Length of Stay (days)"))
    rows += [(code_group_column(i + 1), name) for i, name in enumerate(CODE_GROUP_NAMES)]
    return rows
