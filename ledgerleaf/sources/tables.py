"""Catalog of the input tables, with explicit schemas, and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


class Tables:
    """Lazy access to the tables below one folder: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.read(name)

    @property
    def texts(self) -> DataFrame:
        """``documents`` with enough partitions to keep every core busy on long texts."""
        return spread(self.documents, "doc_id")

    @property
    def webpages(self) -> DataFrame:
        return spread(self.pages, "page_id")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.base}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a small table that arrives in fewer splits than there are cores.

    Large tables have more splits than cores and are returned as they are.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, key) if df.rdd.getNumPartitions() < wanted else df


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at ``path`` and return it re-read."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append rows; columns may be added over time (see :func:`read_merged`)."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files were appended under a growing schema."""
    return spark.read.option("mergeSchema", "true").parquet(path)
