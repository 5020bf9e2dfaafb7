"""mdmspark: master-data tables for card-payment records, built from dated
source snapshots with built-in Spark expressions only.

Layout: ``functions`` (Column -> Column builders), ``operators``
(de-duplication, quality rules), ``sources`` / ``sinks`` (JDBC, Parquet,
CSV, dated snapshots), ``plans`` (entity pipelines and publication).
"""

__version__ = "0.1.0"
