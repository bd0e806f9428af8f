"""Multi-step jobs: daily partition ETL, SQL step scripts, join-side helpers."""
