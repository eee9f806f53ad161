"""logwright: server-log analytics on Spark.

Raw HTTP access and HDFS logs are parsed with column expressions into a
typed four-table model, stored as partitioned Parquet (or staged CSV), and
queried through a catalog of parameterized DataFrame queries.
"""

__version__ = "0.1.0"
