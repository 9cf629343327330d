"""Query plans of the engine: silver transforms, gold builders, reports, checks, incremental state,
catalog tables and the daily runs."""
