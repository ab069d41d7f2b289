"""sluice — land, slice, audit and check data with plain Spark DataFrames.

Modules:
    sluice.context     run identity (run_id, load_dt) and shared scratch folders
    sluice.sources     source registry, lossless CSV/JSON/XML readers and writers
    sluice.operators   audit tags, column sanitizing, global rank / slicer,
                       quality checks, history (SCD2, upserts), profiling
    sluice.functions   column-expression helpers (name rules, date parsing)
    sluice.plans       multi-step jobs: chunking, loads, date dimension, event log
    sluice.streaming   available-now file ingestion and streaming upserts
"""

__version__ = "0.1.0"
