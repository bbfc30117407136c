"""Co-located role tables: write the property-keyed roles once, bucketed by
the numeric key, and run every report of the day on them.

Bucketed tables with the same bucket count on the join key need no shuffle
to be joined: the master-keyed join chains (R4-R7, R15/R16) then shuffle
only their derived side inputs.  Tables go to the session's catalog
(``spark.sql.warehouse.dir``, shared storage on a cluster); each run writes
a fresh database name, so nothing is rewritten in place.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .bindings import Tables
from .reports import MONTH

# role -> numeric key it is joined on
KEYED_ROLES = {
    "property_master": "nid",
    "crm_deal": "nid",
    "crm_deal_raw": "nid",
    "intake_detail": "nid",
    "seller_intake": "nid",
    "listing_card": "nid",
}


def materialize_roles(spark: SparkSession, t: Tables, database: str, buckets: int,
                      roles: dict[str, str] | None = None) -> Tables:
    """Write ``roles`` as tables bucketed (and sorted) by their key into
    ``database`` and return a Tables view reading them; other roles pass
    through unchanged."""
    roles = roles or KEYED_ROLES
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = Tables(t)
    for role, key in roles.items():
        name = f"{database}.{role}"
        (t[role].write.mode("overwrite").format("parquet")
         .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
        out[role] = spark.table(name)
    return out


def visit_log_by_month(t: Tables, folder: str) -> Tables:
    """Write the visit log partitioned by the month of its last change and return a Tables view reading it: reports
    that start at a date (R14-R18) read the partitions from there on."""
    log = t.visit_log.withColumn(MONTH, F.substring("modified_date", 1, 7))
    # a month of any size is dealt over several tasks
    log.repartition(MONTH, F.pmod(F.xxhash64("record_id"), F.lit(16))).write.mode("overwrite").partitionBy(MONTH).parquet(folder)
    out = Tables(t)
    out["visit_log"] = log.sparkSession.read.schema(log.schema).parquet(folder)
    return out
