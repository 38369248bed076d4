"""Measurement families: long event tables -> one row per subject.

The central operator is ``subject_measures``: for each event table it runs a
single scan and a single grouped aggregate in which every family is a
conditional sum/count (``sum(CASE WHEN item IN (...) THEN v END)``). Catalyst
does not fuse separate filter -> group branches over one table, so building
them as one aggregate is what turns 15 scans and 11 joins into 3 scans and 2
joins. The aggregate is algebraic, so Spark runs a partial (map-side)
aggregate before the shuffle: a subject with a third of all events still
sends one row per map task, never its raw events, through the exchange.

Means are Spark's ``avg``; a component that declares a ``scale`` is summed
exactly as DECIMAL instead, so its mean does not depend on partitioning, task
retries or summation order (see ``functions.expressions.mean``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohort_features.functions.catalog import CODE_COUNT_COLUMNS, Component, Measure, MeasureCatalogue
from cohort_features.functions.expressions import (
    code_group,
    fahrenheit_to_celsius,
    mean,
    merge_truthy,
    round_half_up,
    safe_numeric,
    safe_ratio,
)


N_CODES = "n_codes"


def _value(df: DataFrame, comp: Component) -> Column:
    raw = F.col(comp.value_col)
    if isinstance(df.schema[comp.value_col].dataType, StringType):
        raw = safe_numeric(raw)
    else:
        raw = raw.cast("double")
    if comp.transform is None:
        return raw
    if comp.transform == "f_to_c":
        return fahrenheit_to_celsius(raw)
    if comp.transform == "percent":
        return raw / 100
    raise ValueError(f"unknown transform {comp.transform!r}")


def _value_columns(
    df: DataFrame, components, item_col: str
) -> tuple[list[Column], dict[Component, str]]:
    """One projected value column per distinct (value column, transform).

    Each value is converted once per row, however many families read it, and
    only on rows whose item some family actually reads that way: a text
    column shared by a few items is not parsed for every other event.
    """
    all_items = {i for c in components for i in c.items}
    groups: dict[tuple[str, str | None], list[Component]] = {}
    for c in components:
        groups.setdefault((c.value_col, c.transform), []).append(c)
    cols: list[Column] = []
    by_comp: dict[Component, str] = {}
    for n, comps in enumerate(groups.values()):
        name = f"_m{n}"
        value = _value(df, comps[0])
        items = {i for c in comps for i in c.items}
        if items != all_items:
            value = F.when(F.col(item_col).isin(sorted(items, key=str)), value)
        cols.append(value.alias(name))
        for c in comps:
            by_comp[c] = name
    return cols, by_comp


def component_mean(comp: Component, value: Column, item_col: str) -> Column:
    """The conditional mean of one family, named after it."""
    return mean(F.when(F.col(item_col).isin(list(comp.items)), value), comp.scale).alias(comp.name)


def source_aggregate(
    df: DataFrame,
    components: tuple[Component, ...] | list[Component],
    subject_col: str = "subject_id",
    item_col: str = "itemid",
    code_col: str | None = None,
) -> DataFrame:
    """One scan + one grouped aggregate for all families of one event table.

    The coarse ``isin`` over the union of item ids is pushed into the Parquet
    scan (row-group skipping on min/max and dictionary filters). Values are
    converted once per row in a projection; each family then adds a
    conditional mean to the same partial aggregate.

    ``code_col``: the rows also carry diagnosis codes; the same aggregate then
    holds the 20 chapter counts and ``n_codes``, the number of non-NULL codes.
    """
    items = sorted({i for c in components for i in c.items}, key=str)
    value_cols, by_comp = _value_columns(df, components, item_col)
    wanted = F.col(item_col).isin(items)
    aggs = [component_mean(c, F.col(by_comp[c]), item_col) for c in components]
    extra = []
    if code_col is not None:
        wanted = wanted | F.col(code_col).isNotNull()
        extra = [code_group(F.col(code_col)).alias("_group"), F.col(code_col).isNotNull().alias("_coded")]
        aggs += [*chapter_counts("_group"), F.count_if("_coded").alias(N_CODES)]
    rows = df.filter(wanted).select(subject_col, item_col, *value_cols, *extra)
    return rows.groupBy(subject_col).agg(*aggs)


def chapter_counts(group_col: str) -> list[Column]:
    """The 20 chapter counts as one aggregate column each."""
    return [F.count_if(F.col(group_col) == F.lit(i)).alias(c) for i, c in enumerate(CODE_COUNT_COLUMNS, 1)]


def _measure_expr(m: Measure, resolved: dict[str, Column], components: set[str]) -> Column:
    def arg(name: str) -> Column:
        if name in resolved:
            return resolved[name]
        if name in components:
            return F.col(name)
        raise KeyError(f"measure {m.name!r} depends on unknown {name!r}")

    if m.kind == "mean":
        (src,) = m.inputs
        out = arg(src)
    elif m.kind == "merge":
        out = merge_truthy(arg(m.inputs[0]), arg(m.inputs[1]))
    elif m.kind == "ratio":
        out = safe_ratio(arg(m.inputs[0]), arg(m.inputs[1]))
    else:
        raise ValueError(f"unknown measure kind {m.kind!r}")
    return out if m.digits is None else round_half_up(out, m.digits)


def derive_measures(
    aggregated: DataFrame, catalogue: MeasureCatalogue, subject_col: str = "subject_id", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Turn per-component means into the catalogue's measures."""
    components = {c.name for c in catalogue.components}
    resolved: dict[str, Column] = {}
    for m in catalogue.measures:
        resolved[m.name] = _measure_expr(m, resolved, components)
    return aggregated.select(
        subject_col, *[resolved[m.name].alias(m.name) for m in catalogue.visible()], *keep
    )


def _inner_safe(catalogue: MeasureCatalogue, source: str) -> bool:
    """True when a required measure depends on ``source`` alone, so a subject
    without rows in ``source`` cannot survive completion anyway."""
    return any(
        catalogue.sources_of(m.name) == {source}
        for m in catalogue.measures
        if m.required and m.visible
    )


def subject_measures(
    sources: dict[str, DataFrame],
    catalogue: MeasureCatalogue,
    subject_col: str = "subject_id",
    item_col: str = "itemid",
    complete: bool = False,
    code_source: str | None = None,
    code_col: str = "icd9_code",
) -> DataFrame:
    """All measures of ``catalogue``, one row per subject (A5 + J4 + J5 + J6).

    ``complete=False``: every subject with a row in any source, measures
    possibly NULL (per-source aggregates are full-outer joined).
    ``complete=True``: only subjects with every required measure non-NULL;
    sources that alone decide a required measure are inner-joined, which
    shrinks the subject table before it meets anything larger.

    Each per-source aggregate is unique per subject and already hash
    partitioned on it, so the joins between them are skew-free and reuse that
    partitioning.

    ``code_source`` names a source whose rows also carry diagnosis codes in
    ``code_col``: the subjects' 20 chapter counts then come from the same scan
    and aggregate, and only subjects with a code are kept.
    """
    parts = []
    for source in catalogue.sources():
        comps = catalogue.components_of(source)
        codes = code_col if source == code_source else None
        agg = source_aggregate(sources[source], comps, subject_col, item_col, codes)
        if codes:
            agg = agg.filter(F.col(N_CODES) > 0)
        parts.append((source, agg))

    def inner(name: str) -> bool:
        return name == code_source or (complete and _inner_safe(catalogue, name))

    def join(left, right):
        name, df = right
        return left.join(df, on=subject_col, how="inner" if inner(name) else "full")

    # inner joins first so the outer ones see the smallest inputs
    parts.sort(key=lambda p: not inner(p[0]))
    merged = reduce(join, parts[1:], parts[0][1])
    if code_source and not complete:
        merged = merged.filter(F.col(N_CODES) > 0)  # a full outer join may bring others back
    out = derive_measures(merged, catalogue, subject_col, CODE_COUNT_COLUMNS if code_source else ())
    if complete:
        out = out.dropna(subset=list(catalogue.required()))
    return out


def group_mean(
    df: DataFrame, key: str, value: str, out: str, digits: int | None = None, scale: int | None = None
) -> DataFrame:
    """Grouped mean of one column (A1, or A2 with ``digits``); ``scale`` as in
    ``expressions.mean``."""
    v = safe_numeric(value) if isinstance(df.schema[value].dataType, StringType) else F.col(value)
    agg = df.groupBy(key).agg(mean(v, scale).alias(out))
    return agg if digits is None else agg.select(key, round_half_up(out, digits).alias(out))


def merge_sources(
    left: DataFrame, right: DataFrame, key: str, a: str, b: str, out: str, digits: int | None = 2
) -> DataFrame:
    """Full outer USING join of two per-key means, merged by truthiness (J4 + E3)."""
    merged = merge_truthy(F.col(a), F.col(b))
    if digits is not None:
        merged = round_half_up(merged, digits)
    return left.join(right, on=key, how="full").select(key, merged.alias(out))


def ratio_join(
    num: DataFrame, den: DataFrame, key: str, a: str, b: str, out: str, digits: int | None = 2
) -> DataFrame:
    """Inner join of two per-key values and their ratio; 0 denominators -> NULL."""
    ratio = safe_ratio(F.col(a), F.col(b))
    if digits is not None:
        ratio = round_half_up(ratio, digits)
    return num.join(den, on=key, how="inner").select(key, ratio.alias(out))


def per_family_chain(
    sources: dict[str, DataFrame],
    catalogue: MeasureCatalogue,
    subject_col: str = "subject_id",
    item_col: str = "itemid",
) -> DataFrame:
    """The literal plan shape: one filter -> group -> mean branch per family,
    inner-joined one after another, then rows with a NULL measure dropped.

    Kept as the baseline ``subject_measures(complete=True)`` is checked and
    benchmarked against; it scans each event table once per family.
    """
    components = {c.name: c for c in catalogue.components}
    family: dict[str, DataFrame] = {}
    for name, comp in components.items():
        src = sources[comp.source]
        family[name] = src.filter(F.col(item_col).isin(list(comp.items))).groupBy(
            subject_col
        ).agg(component_mean(comp, _value(src, comp), item_col))

    frames: dict[str, DataFrame] = {}
    for m in catalogue.measures:
        ins = [frames[i] if i in frames else family[i] for i in m.inputs]
        how = "full" if m.kind == "merge" else "inner"
        joined = reduce(lambda l, r: l.join(r, on=subject_col, how=how), ins[1:], ins[0])
        resolved = {i: F.col(i) for i in m.inputs if i in frames}
        expr = _measure_expr(m, resolved, set(components))
        frames[m.name] = joined.select(subject_col, expr.alias(m.name))

    visible = [m for m in catalogue.measures if m.visible]
    out = reduce(
        lambda l, r: l.join(r, on=subject_col, how="inner"),
        [frames[m.name] for m in visible[1:]],
        frames[visible[0].name],
    )
    return out.dropna(subset=list(catalogue.required()))

