"""Sources (parquet / csv scans, the churn frame) and sinks (model tables, reports)."""

from churnspark.sources.tables import read_table, normalise_nan, churn_frame, load_frame

__all__ = ["read_table", "normalise_nan", "churn_frame", "load_frame"]
