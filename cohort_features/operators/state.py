"""Measures from mergeable state: batches of events are summed once (A5).

A state table holds one row per subject with the sum and count of every
component. States of batches add up, and the catalogue's measures come from
the merged state, so old events are never read again. Components with a
declared scale are summed as DECIMAL: any cutting into batches, in any order,
gives the same doubles as one pass over all events. Components without one sum
doubles, equal up to the order of addition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.functions.catalog import Component, MeasureCatalogue
from cohort_features.operators.measures import _value_columns, derive_measures


def _sum_type(c: Component) -> str:
    return "double" if c.scale is None else f"decimal(38,{c.scale})"


def batch_state(df: DataFrame, components: tuple[Component, ...], subject_col: str = "subject_id", item_col: str = "itemid") -> DataFrame:
    """The state of one batch of one source: ``<component>_sum`` and
    ``<component>_count`` per subject that has a row of a wanted item."""
    values, by_comp = _value_columns(df, components, item_col)
    items = sorted({i for c in components for i in c.items}, key=str)
    aggs = []
    for c in components:
        v = F.when(F.col(item_col).isin(list(c.items)), F.col(by_comp[c]))
        v = v if c.scale is None else v.cast(f"decimal(28,{c.scale})")
        aggs += [F.sum(v).cast(_sum_type(c)).alias(f"{c.name}_sum"), F.count(v).alias(f"{c.name}_count")]
    return df.filter(F.col(item_col).isin(items)).select(subject_col, item_col, *values).groupBy(subject_col).agg(*aggs)


def merge_states(states: list[DataFrame], components: tuple[Component, ...], subject_col: str = "subject_id") -> DataFrame:
    """One state of several: a union and one aggregate, whatever the order."""
    aggs = []
    for c in components:
        aggs += [F.sum(f"{c.name}_sum").cast(_sum_type(c)).alias(f"{c.name}_sum"), F.sum(f"{c.name}_count").alias(f"{c.name}_count")]
    return reduce(DataFrame.unionByName, states).groupBy(subject_col).agg(*aggs)


def measures_of_state(state: DataFrame, catalogue: MeasureCatalogue, subject_col: str = "subject_id") -> DataFrame:
    """The catalogue's measures, as ``subject_measures`` gives them."""
    means = [F.try_divide(F.col(f"{c.name}_sum").cast("double"), F.col(f"{c.name}_count")).alias(c.name) for c in catalogue.components]
    return derive_measures(state.select(subject_col, *means), catalogue, subject_col)
