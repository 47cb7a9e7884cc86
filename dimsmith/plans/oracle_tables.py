"""Conformed tables of the oracle, written out in DuckDB SQL.

Nothing here is derived from the declared model, so a wrong source expression or
type there shows as a difference between the two engines.
"""

from __future__ import annotations

_LOCATION = """SELECT n_nationkey::BIGINT AS location_id, n_name::VARCHAR AS name, n_regionkey::BIGINT AS region_id,
    concat('location ', n_nationkey) AS comment FROM nation"""
_REGION = """SELECT r_regionkey::BIGINT AS region_id, r_name::VARCHAR AS name, concat('region ', r_regionkey) AS comment
    FROM region"""
_CUSTOMER = """SELECT c_custkey::BIGINT AS customer_id, c_name::VARCHAR AS name, concat('addr-c-', c_custkey) AS address,
    c_nationkey::BIGINT AS location_id, concat('20-', c_custkey) AS phone, c_acctbal::DECIMAL(12,2) AS account_balance_usd,
    c_mktsegment::VARCHAR AS market_segment,
    CASE WHEN c_custkey % 5 <> 0 THEN concat('note ', c_custkey % 7) END AS comment FROM customer"""

TABLES = {
    "region": _REGION,
    "region_main": f"{_REGION} WHERE r_regionkey < 4",
    "location": _LOCATION,
    "location_bad_fk": _LOCATION,
    "customer": _CUSTOMER,
    "part": """SELECT p_partkey::BIGINT AS part_id, p_name::VARCHAR AS name, concat('Mfr#', p_partkey % 5 + 1) AS manufacturer,
    p_brand::VARCHAR AS brand, p_type::VARCHAR AS type, p_size::BIGINT AS size_centimeters,
    concat('BOX ', p_partkey % 4) AS container, p_retailprice::DECIMAL(12,2) AS retail_price_usd, NULL::VARCHAR AS comment
    FROM part""",
    "supplier": """SELECT s_suppkey::BIGINT AS supplier_id, s_name::VARCHAR AS name, concat('addr-s-', s_suppkey) AS address,
    s_nationkey::BIGINT AS location_id, concat('10-', s_suppkey) AS phone, s_acctbal::DECIMAL(12,2) AS account_balance_usd,
    NULL::VARCHAR AS comment FROM supplier""",
    "sales_order": """SELECT o_orderkey::BIGINT AS sales_order_id, o_custkey::BIGINT AS customer_id,
    o_orderstatus::VARCHAR AS order_status, o_totalprice::DECIMAL(12,2) AS total_price_usd, o_orderdate::DATE AS order_date,
    o_orderpriority::VARCHAR AS order_priority, concat('Clerk#', o_orderkey % 10) AS clerk, 0::BIGINT AS ship_priority,
    NULL::VARCHAR AS comment FROM orders""",
    "inventory": """SELECT DISTINCT l_partkey::BIGINT AS part_id, l_suppkey::BIGINT AS supplier_id,
    ((7 * l_partkey + 3 * l_suppkey) % 1000)::BIGINT AS available_amount,
    (((l_partkey + l_suppkey) % 10000) / 100)::DECIMAL(12,2) AS supplier_cost_usd, NULL::VARCHAR AS comment FROM lineitem""",
    "lineitem": """SELECT l_linenumber::BIGINT AS line_number, l_orderkey::BIGINT AS sales_order_id, l_partkey::BIGINT AS part_id,
    l_suppkey::BIGINT AS supplier_id, l_quantity::DECIMAL(12,2) AS quantity,
    l_extendedprice::DECIMAL(12,2) AS extended_price_usd, l_discount::DECIMAL(12,2) AS discount_percent,
    l_tax::DECIMAL(12,2) AS tax_percent, l_returnflag::VARCHAR AS return_flag, l_linestatus::VARCHAR AS line_status,
    l_shipdate::DATE AS ship_date, (l_shipdate::DATE + INTERVAL 7 DAY)::DATE AS commit_date,
    (l_shipdate::DATE + INTERVAL 14 DAY)::DATE AS receipt_date, concat('INS ', l_orderkey % 4) AS ship_instructions,
    concat('MODE ', l_orderkey % 7) AS ship_mode, NULL::VARCHAR AS comment FROM lineitem""",
}
SOURCE_CUSTOMER = _CUSTOMER
EVENTS = """SELECT user_id::BIGINT AS user_id, ts::TIMESTAMP AS ts, event_id::BIGINT AS event_id, event_type::VARCHAR AS event_type,
    value::DECIMAL(12,2) AS value, props::VARCHAR AS props FROM events"""
