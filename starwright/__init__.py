"""starwright — a PySpark-native sales-star analytics engine.

Layers: ``sources`` (driver tables, raw fixtures, snapshots, artifacts),
``plans`` (staging, star, calendar, monthly fact, measures, rules, telemetry,
reports, pipeline), ``operators`` (quality rules, contracts, upsert, ranking,
lineage closure), ``functions`` (column helpers), ``queries`` (the registered
queries with their DuckDB oracles).
"""
