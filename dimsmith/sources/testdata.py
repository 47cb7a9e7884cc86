"""Readers for the raw parquet tables and the conformed star model."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from dimsmith.sources.model import (EVENTS_FEED, SOURCE_SYSTEM_CUSTOMER, STAR_SPECS,
                                    TableSpec, conform)

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
              "lineitem", "events")


# Columns of the raw files. Reading with them needs no look into the files.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reader of one raw table, by its declared columns."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def conformed(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    if spec.source is None:
        raise ValueError(f"{spec.name} is derived, not read")
    return conform(raw(spark, sf_dir, spec.source), spec)


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All star tables, conformed (lazy: nothing is read until an action)."""
    return {name: conformed(spark, sf_dir, spec) for name, spec in STAR_SPECS.items()}


def source_system_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed(spark, sf_dir, SOURCE_SYSTEM_CUSTOMER)


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed(spark, sf_dir, EVENTS_FEED)
