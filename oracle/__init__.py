"""DuckDB oracle SQL for the registered queries.

Every oracle starts from the raw test tables (pre-registered as views in
DuckDB) and rebuilds the ``usecases`` fixture as CTEs, so the check is
independent of any Spark code.
"""
