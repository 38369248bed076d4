"""Subject measures kept current over an event stream.

The batch operator's per-table aggregate is a set of means (sums and counts)
per subject, which Structured Streaming maintains incrementally: each micro-batch
is partially aggregated, merged into per-subject state (one row per subject,
so state grows with the number of subjects, not events) and the derived
measures are recomputed for the subjects that changed.

Only the measures of one event table are maintained per stream (joining two
streaming aggregates is not supported by Spark); combine the per-table
outputs downstream, as the batch operator does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cohort_features.functions.catalog import MeasureCatalogue
from cohort_features.operators.measures import derive_measures, source_aggregate


def _single_source(catalogue: MeasureCatalogue, source: str) -> MeasureCatalogue:
    comps = catalogue.components_of(source)
    names = {c.name for c in comps}
    keep = []
    for m in catalogue.measures:
        if all(i in names or i in {k.name for k in keep} for i in m.inputs):
            keep.append(m)
    return MeasureCatalogue(components=comps, measures=tuple(keep))


def streaming_measures(
    events: DataFrame,
    catalogue: MeasureCatalogue,
    source: str,
    subject_col: str = "subject_id",
    item_col: str = "itemid",
) -> DataFrame:
    """Streaming DataFrame of per-subject measures computable from ``source``."""
    cat = _single_source(catalogue, source)
    agg = source_aggregate(events, cat.components, subject_col, item_col)
    return derive_measures(agg, cat, subject_col)


def start_measure_stream(
    measures: DataFrame,
    checkpoint_location: str,
    sink: str,
    output_mode: str,
    query_name: str = "subject_measures",
    trigger_available_now: bool = True,
    path: str | None = None,
) -> StreamingQuery:
    """Start writing the streaming measures.

    ``checkpoint_location`` must be on shared storage (under the folder named
    by ``spark.checkpoint.dir``) so a restarted driver resumes from the
    committed offsets and state. Sink and mode are the caller's choice:
    ``"update"`` into a table emits only the subjects whose measures changed;
    ``"complete"`` rewrites every subject at each micro-batch, and into the
    ``"memory"`` sink (for tests) puts them all on the driver.
    """
    writer = (
        measures.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint_location)
        .queryName(query_name)
        .format(sink)
    )
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()
