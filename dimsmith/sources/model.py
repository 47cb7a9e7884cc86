"""Declared star and dimension model: names, types, keys, references, trust.

Every table is a ``TableSpec``. Columns are mapped **by name** from a source
expression (never by position, so a reordered source cannot shift keys into the
wrong columns). Keys and references are declarations; whether they are trusted
(``RELY``) is a property of the spec, consumed by the star operators, and the
audits in ``dimsmith.operators.constraints`` check them against the data.

Source expressions are plain SQL over the raw tables, written in the subset
that Spark SQL and DuckDB read the same way, so the oracle queries can build
the same conformed tables independently.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(12,2)"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str                     # Spark DDL type
    source: str                    # SQL expression over the source table
    nullable: bool = True
    max_length: int | None = None  # varchar(n)
    comment: str | None = None

    @property
    def decimal(self) -> tuple[int, int] | None:
        m = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", self.dtype)
        return (int(m.group(1)), int(m.group(2))) if m else None


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    source: str | None = None           # raw table; None = derived table
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    trusted: bool = True                 # RELY on every declared constraint
    where: str | None = None
    distinct: bool = False
    comment: str | None = None

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def untrusted(self) -> "TableSpec":
        return replace(self, trusted=False)

    def schema(self) -> T.StructType:
        fields = []
        for c in self.columns:
            meta = {"comment": c.comment} if c.comment else {}
            fields.append(T.StructField(c.name, T.DataType.fromDDL(c.dtype), c.nullable, meta))
        return T.StructType(fields)


def col(name, dtype, source, nullable=True, max_length=None, comment=None) -> ColumnSpec:
    return ColumnSpec(name, dtype, source, nullable, max_length, comment)


def conformed_columns(spec: TableSpec) -> list[Column]:
    """The spec's columns over its raw columns: source expression, cast, name."""
    return [F.expr(c.source).cast(c.dtype).alias(c.name, metadata={"comment": c.comment} if c.comment else {})
            for c in spec.columns]


def raw_columns(spec: TableSpec, raw: DataFrame) -> list[str]:
    """The raw columns that the spec's source expressions mention."""
    return [c for c in raw.columns if any(re.search(rf"\b{re.escape(c)}\b", col.source) for col in spec.columns)]


def conform(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed CTAS by name: ``select(cast(expr(source)) as name)`` (+ filter/distinct).

    The filter runs first so it reaches the parquet scan; the projection reads
    only the source columns the expressions mention.
    """
    df = raw.where(F.expr(spec.where)) if spec.where else raw
    out = df.select(conformed_columns(spec))
    return out.distinct() if spec.distinct else out


def empty_table(spark, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema())


# ----------------------------------------------------------------------------
# DuckDB names of the declared types (used by the audit oracle only).

_DUCK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
               "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER"}


def duck_type(dtype: str) -> str:
    if dtype.startswith("decimal"):
        return dtype.upper()
    return _DUCK_TYPES[dtype]


# ----------------------------------------------------------------------------
# The star model. Derived text columns (address, phone, clerk, ...) are absent
# from the test tables and built with arithmetic and concatenation.

REGION = TableSpec(
    "region",
    (col("region_id", "bigint", "r_regionkey", False),
     col("name", "string", "r_name", max_length=25),
     col("comment", "string", "'region ' || r_regionkey", max_length=152)),
    source="region", primary_key=("region_id",), comment="Groups of countries")

REGION_MAIN = replace(REGION, name="region_main", where="r_regionkey < 4")

LOCATION = TableSpec(
    "location",
    (col("location_id", "bigint", "n_nationkey", False),
     col("name", "string", "n_name", False, 25),
     col("region_id", "bigint", "n_regionkey", False),
     col("comment", "string", "'location ' || n_nationkey", max_length=152)),
    source="nation", primary_key=("location_id",), unique=(("name",),),
    comment="Countries of customers and suppliers")

# Same rows as LOCATION, with a reference to region_main that is false by design.
LOCATION_BAD_FK = replace(
    LOCATION, name="location_bad_fk",
    foreign_keys=(ForeignKey(("region_id",), "region_main", ("region_id",)),))

PART = TableSpec(
    "part",
    (col("part_id", "bigint", "p_partkey", False),
     col("name", "string", "p_name", False),
     col("manufacturer", "string", "'Mfr#' || (1 + p_partkey % 5)", False),
     col("brand", "string", "p_brand", False),
     col("type", "string", "p_type", False),
     col("size_centimeters", "bigint", "p_size", False),
     col("container", "string", "'BOX ' || (p_partkey % 4)", False),
     col("retail_price_usd", MONEY, "p_retailprice", False),
     col("comment", "string", "NULL")),
    source="part", primary_key=("part_id",), comment="Catalogue of parts")

SUPPLIER = TableSpec(
    "supplier",
    (col("supplier_id", "bigint", "s_suppkey", False),
     col("name", "string", "s_name", False),
     col("address", "string", "'addr-s-' || s_suppkey", False),
     col("location_id", "bigint", "s_nationkey", False),
     col("phone", "string", "'10-' || s_suppkey", False),
     col("account_balance_usd", MONEY, "s_acctbal", False),
     col("comment", "string", "NULL")),
    source="supplier", primary_key=("supplier_id",),
    foreign_keys=(ForeignKey(("location_id",), "location", ("location_id",)),),
    comment="Parties that parts are bought from")

_CUSTOMER_COLUMNS = (
    col("customer_id", "bigint", "c_custkey", False),
    col("name", "string", "c_name", False),
    col("address", "string", "'addr-c-' || c_custkey", False),
    col("location_id", "bigint", "c_nationkey", False),
    col("phone", "string", "'20-' || c_custkey", False, 15),
    col("account_balance_usd", MONEY, "c_acctbal", False),
    col("market_segment", "string", "c_mktsegment", False, 10),
    col("comment", "string", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'note ' || (c_custkey % 7) END",
        comment="free text about the customer"),
)

CUSTOMER = TableSpec(
    "customer", _CUSTOMER_COLUMNS, source="customer", primary_key=("customer_id",),
    foreign_keys=(ForeignKey(("location_id",), "location", ("location_id",)),),
    comment="One row a customer")

SALES_ORDER = TableSpec(
    "sales_order",
    (col("sales_order_id", "bigint", "o_orderkey", False),
     col("customer_id", "bigint", "o_custkey", False),
     col("order_status", "string", "o_orderstatus", max_length=1),
     col("total_price_usd", MONEY, "o_totalprice"),
     col("order_date", "date", "CAST(o_orderdate AS DATE)"),
     col("order_priority", "string", "o_orderpriority", max_length=15),
     col("clerk", "string", "'Clerk#' || (o_orderkey % 10)", max_length=15),
     col("ship_priority", "bigint", "0"),
     col("comment", "string", "NULL", max_length=79)),
    source="orders", primary_key=("sales_order_id",),
    foreign_keys=(ForeignKey(("customer_id",), "customer", ("customer_id",)),),
    comment="One row an order")

INVENTORY = TableSpec(
    "inventory",
    (col("part_id", "bigint", "l_partkey", False),
     col("supplier_id", "bigint", "l_suppkey", False),
     col("available_amount", "bigint", "(l_partkey * 7 + l_suppkey * 3) % 1000", False),
     col("supplier_cost_usd", MONEY, "((l_partkey + l_suppkey) % 10000) / 100", False),
     col("comment", "string", "NULL", max_length=79)),
    source="lineitem", distinct=True, primary_key=("part_id", "supplier_id"),
    foreign_keys=(ForeignKey(("part_id",), "part", ("part_id",)),
                  ForeignKey(("supplier_id",), "supplier", ("supplier_id",))),
    comment="Stock by part and supplier")

LINEITEM = TableSpec(
    "lineitem",
    (col("line_number", "bigint", "l_linenumber", False),
     col("sales_order_id", "bigint", "l_orderkey", False),
     col("part_id", "bigint", "l_partkey", False),
     col("supplier_id", "bigint", "l_suppkey", False),
     col("quantity", MONEY, "l_quantity"),
     col("extended_price_usd", MONEY, "l_extendedprice"),
     col("discount_percent", MONEY, "l_discount"),
     col("tax_percent", MONEY, "l_tax"),
     col("return_flag", "string", "l_returnflag", max_length=1),
     col("line_status", "string", "l_linestatus", max_length=1),
     col("ship_date", "date", "CAST(l_shipdate AS DATE)"),
     col("commit_date", "date", "CAST(l_shipdate AS DATE) + 7"),
     col("receipt_date", "date", "CAST(l_shipdate AS DATE) + 14"),
     col("ship_instructions", "string", "'INS ' || (l_orderkey % 4)", max_length=25),
     col("ship_mode", "string", "'MODE ' || (l_orderkey % 7)", max_length=10),
     col("comment", "string", "NULL", max_length=44)),
    source="lineitem", primary_key=("line_number", "sales_order_id"),
    foreign_keys=(ForeignKey(("sales_order_id",), "sales_order", ("sales_order_id",)),
                  ForeignKey(("part_id",), "part", ("part_id",)),
                  ForeignKey(("supplier_id",), "supplier", ("supplier_id",))),
    comment="Order lines")

LOYALTY_CUSTOMER = TableSpec(
    "loyalty_customer",
    (col("customer_id", "bigint", "customer_id", False),
     col("level", "string", "level", False),
     col("type", "string", "type", False, comment="how the customer got its level"),
     col("points_amount", "bigint", "points_amount", False),
     col("comment", "string", "comment",
         comment="free text about the status")),
    primary_key=("customer_id",),
    foreign_keys=(ForeignKey(("customer_id",), "customer", ("customer_id",)),),
    comment="Levels of customers by order volume")

STAR_SPECS: dict[str, TableSpec] = {s.name: s for s in (
    REGION, REGION_MAIN, PART, LOCATION, SUPPLIER, CUSTOMER, SALES_ORDER,
    INVENTORY, LINEITEM, LOCATION_BAD_FK)}

# ----------------------------------------------------------------------------
# Dimension side: the operational customer table, its change feed, and the
# MERGE-maintained Type-2 dimension.

SOURCE_SYSTEM_CUSTOMER = replace(
    CUSTOMER, name="source_system_customer", foreign_keys=(), trusted=False,
    comment="Customers as the operational system has them")

SRC_CUSTOMER = TableSpec(
    "src_customer",
    tuple(replace(c, source=c.name) for c in _CUSTOMER_COLUMNS)
    + (col("__ldts", "timestamp_ntz", "__ldts", False),),
    primary_key=("customer_id", "__ldts"), trusted=False,
    comment="Stamped batches of customer rows")

# Hash column lists (order is significant: it is the order of the hashed text).
# Type-2 history: every payload column.
CUSTOMER_T2_TRACKED = ("name", "location_id", "phone", "address",
                       "account_balance_usd", "market_segment", "comment")
# Type-2+1 history: Type-2 part and Type-1 part.
CUSTOMER_T2N1_TYPE2 = ("name", "account_balance_usd", "market_segment", "comment")
CUSTOMER_T2N1_TYPE1 = ("location_id", "phone", "address")
# MERGE-loaded dimension: key plus every payload column.
CUSTOMER_MERGE_HASHED = ("customer_id", "name", "address", "location_id", "phone",
                         "account_balance_usd", "market_segment", "comment")
CUSTOMER_PAYLOAD = ("name", "address", "location_id", "phone",
                    "account_balance_usd", "market_segment", "comment")

DIM_CUSTOMER = TableSpec(
    "dim_customer",
    (col("customer_id", "bigint", "customer_id", False),
     col("__from_dts", "timestamp_ntz", "__from_dts", False,
         comment="start of validity"),
     col("__to_dts", "timestamp_ntz", "__to_dts", False,
         comment="end of validity; the high date while open"),
     col("name", "string", "name", False),
     col("address", "string", "address", False),
     col("location_id", "bigint", "location_id", False),
     col("phone", "string", "phone", False, 15),
     col("account_balance_usd", MONEY, "account_balance_usd", False),
     col("market_segment", "string", "market_segment", False, 10),
     col("comment", "string", "comment"),
     col("__load_dts", "timestamp_ntz", "__load_dts"),
     col("__rec_version", "bigint", "__rec_version", False,
         comment="version number of the key, from 1"),
     col("__is_latest", "boolean", "__is_latest", False,
         comment="whether this version is open"),
     col("__create_dts", "timestamp_ntz", "__create_dts", False,
         comment="time of the key's first version"),
     col("__update_dts", "timestamp_ntz", "__update_dts", False,
         comment="time this version was written"),
     col("__t2diff_hash", "binary", "__t2diff_hash", False,
         comment="hash of the columns whose change makes a version"),
     col("__t1diff_hash", "binary", "__t1diff_hash", False,
         comment="hash of the overwritten columns; none here")),
    primary_key=("customer_id", "__from_dts"))

EVENTS_FEED = TableSpec(
    "events_feed",
    (col("user_id", "bigint", "user_id", False),
     col("ts", "timestamp_ntz", "ts", False),
     col("event_id", "bigint", "event_id", False),
     col("event_type", "string", "event_type"),
     col("value", MONEY, "value"),
     col("props", "string", "props")),
    source="events", primary_key=("user_id", "ts"), trusted=False)


def star_specs(trust: bool = True) -> dict[str, TableSpec]:
    return {k: (v if trust else v.untrusted()) for k, v in STAR_SPECS.items()}


def columns_of(spec: TableSpec, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in spec.column_names if c not in exclude]
