"""cohort_features: event-level records to entity-level features and models on Spark.

Subpackages
-----------
sources    typed readers (CSV / Parquet with explicit schemas), feature-table IO
functions  the fixed-value catalogue and pure ``Column -> Column`` builders
operators  cohort building, one-pass measure aggregation, feature assembly,
           metrics, model bake-offs / tuning, batch scoring
plans      the operators wired over the driver test tables (query register + SQL oracle)
streaming  the measure aggregation over a ``readStream`` source
"""

from cohort_features.session import build_session, materialize, shared_dir

__all__ = ["build_session", "materialize", "shared_dir"]
