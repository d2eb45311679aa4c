"""DataFrame -> DataFrame operators: staging, models, marts, metrics, quality, contract, alerts, incremental."""
