"""casetrail: governed case-workflow metrics on Spark.

Layers: raw sources -> staging -> intermediate models -> daily marts ->
analyst metrics, with data-quality checks, a metric contract for safe
re-aggregation, threshold alerts, incremental upserts and a streaming path.

Typical use::

    from casetrail import Models, local_session
    spark = local_session()
    m = Models(spark, "/path/to/tables")
    m.file_upload_daily.write.parquet(...)
"""

from .plans.models import Models
from .session import configure, local_session

__all__ = ["Models", "configure", "local_session"]
