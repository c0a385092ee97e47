"""The medallion jobs: Bronze ingestion, Silver builds, Gold builds, reconciliation.

Each job is a function from tables (folders under a :class:`~tidemark.jobs.
lake.Lake`) to tables. Bronze tables are append-only Parquet partitioned by
retrieval day; Silver and Gold tables are upserted snapshot tables, so every
job can be rerun.
"""
