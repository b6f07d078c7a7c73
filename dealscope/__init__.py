"""dealscope: Spark-native opportunity insights.

Reads a table of sales opportunities ("use cases"), selects the rows that
changed since the last run, enriches them with guarded, de-duplicated
inference stages, parses structured answers into typed scores, upserts the
narrow result into a versioned parquet table and serves reporting views,
per-manager roll-ups and text clustering.  Every operator is a plain
``DataFrame -> DataFrame`` function on Spark SQL / MLlib.
"""

from dealscope.settings import Settings

__all__ = ["Settings"]
