"""DuckDB SQL of every catalogue query: the independent correctness oracle.

The oracle reads the raw test tables (registered as views under their own
names) and rebuilds the conformed model by SQL of its own
(``oracle_tables``); everything after that (feeds, hashes, windows, joins, merges,
audits) is written here again in plain SQL, not derived from the Spark code.
"""

from __future__ import annotations

from collections.abc import Sequence

from dimsmith.plans import oracle_tables
from dimsmith.sources.model import (CUSTOMER_MERGE_HASHED, CUSTOMER_PAYLOAD, CUSTOMER_T2_TRACKED,
                                    CUSTOMER_T2N1_TYPE1, CUSTOMER_T2N1_TYPE2, STAR_SPECS, TableSpec, duck_type)

HIGH = "TIMESTAMP '9999-12-31 00:00:00'"
EPOCH = "TIMESTAMP '2024-01-01 00:00:00'"
NULL_HASH = "sha1('*null*')"
FULL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
CUSTOMER_COLS = ("customer_id",) + CUSTOMER_PAYLOAD


def sql_hash(cols: Sequence[str]) -> str:
    return "sha1(" + " || '|' || ".join(
        f"coalesce(upper(trim(CAST({c} AS VARCHAR))), '^^')" for c in cols) + ")"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def star_ctes(names: Sequence[str] | None = None) -> list[str]:
    names = names or list(STAR_SPECS)
    return [f"m_{n} AS ({oracle_tables.TABLES[n]})" for n in names]


def ssc_cte() -> str:
    return f"ssc AS ({oracle_tables.SOURCE_CUSTOMER})"


def feed_ctes(batches: int = 4) -> list[str]:
    cols = ", ".join(CUSTOMER_COLS)
    parts = [f"SELECT {cols}, {EPOCH} AS __ldts FROM ssc WHERE customer_id % 4 = 0"]
    for b in range(1, batches + 1):
        phone = f"'20-' || customer_id || '-{b}'" if b % 2 else "phone"
        bal = (f"CASE WHEN customer_id % 3 = 0 AND (customer_id + {b}) % 2 = 0 THEN "
               f"CAST(account_balance_usd + CAST(((customer_id * 31 + {b} * 17) % 18447 - 9223) / 100.0 "
               f"AS DECIMAL(12,2)) AS DECIMAL(12,2)) ELSE account_balance_usd END")
        parts.append(
            f"SELECT customer_id, name, address, location_id, {phone} AS phone, {bal} AS account_balance_usd, "
            f"market_segment, comment, {EPOCH} + INTERVAL {10 * b} MINUTE AS __ldts FROM ssc "
            f"WHERE (customer_id * 7919 + {b} * 104729) % 10 < 3")
    return [ssc_cte(), "feed AS (\n  " + "\n  UNION ALL\n  ".join(parts) + "\n)"]


def events_ctes() -> list[str]:
    return [f"feed AS ({oracle_tables.EVENTS})"]


def with_(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ----------------------------------------------------------------------------
# Histories.

def history_sql(ctes: Sequence[str], key: str, order: str, payload: Sequence[str],
                tracked: Sequence[str], compact: bool) -> str:
    w = f"PARTITION BY {key} ORDER BY {order}"
    body = [f"h AS (SELECT *, {sql_hash(tracked)} AS __t2diff_hash FROM feed)",
            f"p AS (SELECT *, coalesce(lag(__t2diff_hash) OVER ({w}), {NULL_HASH}) AS __prev_t2diff_hash FROM h)"]
    src = "p"
    if compact:
        body.append("k AS (SELECT * FROM p WHERE __t2diff_hash <> __prev_t2diff_hash)")
        src = "k"
    body.append(
        f"s AS (SELECT *, lead({order}) OVER ({w}) AS __nxt, row_number() OVER ({w}) AS __rn, "
        f"first_value({order}) OVER ({w} {FULL}) AS __first, last_value({order}) OVER ({w} {FULL}) AS __last "
        f"FROM {src})")
    body.append(f"t AS (SELECT *, CASE WHEN __nxt IS NULL THEN {HIGH} "
                f"ELSE __nxt - INTERVAL 1 MICROSECOND END AS __to FROM s)")
    select = (f"SELECT CAST({key} AS VARCHAR) || '|' || {ts_text(order)} AS dim_skey, {key}, "
              f"{order} AS __from_dts, __to AS __to_dts, {', '.join(payload)}, {order}, "
              f"CAST(__rn AS BIGINT) AS __rec_version, (__to = {HIGH}) AS __is_latest, "
              f"__first AS __create_dts, {order} AS __update_dts, __last AS __last_update_dts, "
              f"__t2diff_hash, __prev_t2diff_hash FROM t")
    if not compact:
        select += " WHERE __t2diff_hash <> __prev_t2diff_hash"
    return with_(list(ctes) + body, select)


def history_t2n1_sql(ctes: Sequence[str], key: str, order: str, payload: Sequence[str],
                     type2: Sequence[str], type1: Sequence[str]) -> str:
    w = f"PARTITION BY {key} ORDER BY {order}"
    shown = [f"last_value({c}) OVER ({w} {FULL}) AS {c}" if c in type1 else c for c in payload]
    body = [
        f"h AS (SELECT *, {sql_hash(type2)} AS __t2diff_hash, {sql_hash(type1)} AS __t1diff_hash FROM feed)",
        f"i AS (SELECT {key}, {', '.join(shown)}, {order}, __t2diff_hash, "
        f"coalesce(lag(__t2diff_hash) OVER ({w}), {NULL_HASH}) AS __prev_t2diff_hash, __t1diff_hash FROM h)",
        "k AS (SELECT * FROM i WHERE __t2diff_hash <> __prev_t2diff_hash)",
        f"s AS (SELECT *, lead({order}) OVER ({w}) AS __nxt, row_number() OVER ({w}) AS __rn, "
        f"first_value({order}) OVER ({w} {FULL}) AS __first, last_value({order}) OVER ({w} {FULL}) AS __last FROM k)",
        f"t AS (SELECT *, CASE WHEN __nxt IS NULL THEN {HIGH} ELSE __nxt - INTERVAL 1 MICROSECOND END AS __to FROM s)",
    ]
    select = (f"SELECT CAST({key} AS VARCHAR) || '|' || {ts_text(order)} AS dim_skey, {key}, "
              f"{', '.join(payload)}, {order}, {order} AS __update_dts, __t2diff_hash, __prev_t2diff_hash, "
              f"__t1diff_hash, {order} AS __from_dts, __to AS __to_dts, CAST(__rn AS BIGINT) AS __rec_version, "
              f"__first AS __create_dts, __last AS __last_update_dts, (__to = {HIGH}) AS __is_latest FROM t")
    return with_(list(ctes) + body, select)


def customer_t2(compact: bool) -> str:
    return history_sql(feed_ctes(), "customer_id", "__ldts", CUSTOMER_PAYLOAD, CUSTOMER_T2_TRACKED, compact)


def customer_t2n1() -> str:
    return history_t2n1_sql(feed_ctes(), "customer_id", "__ldts", CUSTOMER_PAYLOAD,
                            CUSTOMER_T2N1_TYPE2, CUSTOMER_T2N1_TYPE1)


EVENT_PAYLOAD = ("event_id", "event_type", "value", "props")


def events_t2(compact: bool) -> str:
    return history_sql(events_ctes(), "user_id", "ts", EVENT_PAYLOAD, ("event_type",), compact)


def events_t2n1() -> str:
    return history_t2n1_sql(events_ctes(), "user_id", "ts", EVENT_PAYLOAD, ("event_type",), ("value",))


def point_in_time_sql() -> str:
    hist = customer_t2(True)
    return (f"SELECT e.event_id, e.user_id AS customer_id, e.ts, h.__rec_version, h.account_balance_usd "
            f"FROM events e LEFT JOIN ({hist}) h ON h.customer_id = e.user_id "
            f"AND e.ts BETWEEN h.__from_dts AND h.__to_dts")


def skew_profile_sql(top: int) -> str:
    return with_(feed_ctes(), f"SELECT customer_id, count(*) AS rows FROM feed GROUP BY customer_id "
                              f"ORDER BY rows DESC, customer_id LIMIT {top}")


def as_of_sql(at: str) -> str:
    inner = customer_t2(True)
    return f"SELECT * FROM ({inner}) x WHERE __from_dts <= TIMESTAMP '{at}' AND TIMESTAMP '{at}' <= __to_dts"


# ----------------------------------------------------------------------------
# MERGE.

DIM_COLS = ("customer_id", "__from_dts", "__to_dts") + CUSTOMER_PAYLOAD + (
    "__load_dts", "__rec_version", "__is_latest", "__create_dts", "__update_dts",
    "__t2diff_hash", "__t1diff_hash")


def staged_sql(where: str) -> str:
    return (f"SELECT customer_id, __ldts AS __from_dts, {HIGH} AS __to_dts, {', '.join(CUSTOMER_PAYLOAD)}, "
            f"__ldts AS __load_dts, CAST(1 AS BIGINT) AS __rec_version, TRUE AS __is_latest, "
            f"__ldts AS __create_dts, __ldts AS __update_dts, {sql_hash(CUSTOMER_MERGE_HASHED)} AS __t2diff_hash, "
            f"{NULL_HASH} AS __t1diff_hash FROM feed WHERE {where}")


def merge_changes_ctes(feed: list[str] | None = None) -> list[str]:
    """dim0 = the dimension after merging batch 0 into an empty table;
    chg = changes of the newest batch against dim0."""
    n = ", ".join(f"n.{c}" for c in DIM_COLS)
    ins = ", ".join({"__rec_version": "d.__rec_version + 1 AS __rec_version",
                     "__create_dts": "d.__create_dts AS __create_dts"}.get(c, f"n.{c}") for c in DIM_COLS)
    exp = ", ".join({"__to_dts": "n.__from_dts - INTERVAL 1 MICROSECOND AS __to_dts",
                     "__is_latest": "FALSE AS __is_latest"}.get(c, f"d.{c}") for c in DIM_COLS)
    return (feed or feed_ctes()) + [
        f"dim0 AS ({staged_sql(f'__ldts = {EPOCH}')})",
        f"newest AS ({staged_sql('__ldts = (SELECT max(__ldts) FROM feed)')})",
        "chg AS (\n"
        f"  SELECT {n}, 'new recs' AS __tmp_update_type FROM newest n\n"
        "    WHERE NOT EXISTS (SELECT 1 FROM dim0 d WHERE d.customer_id = n.customer_id)\n"
        f"  UNION ALL SELECT {ins}, 't2 insert' FROM newest n JOIN dim0 d ON d.customer_id = n.customer_id\n"
        "    WHERE d.__is_latest AND n.__t2diff_hash <> d.__t2diff_hash\n"
        f"  UNION ALL SELECT {exp}, 't2 expire' FROM newest n JOIN dim0 d ON d.customer_id = n.customer_id\n"
        "    WHERE d.__is_latest AND n.__t2diff_hash <> d.__t2diff_hash\n)",
    ]


def merge_changes_sql() -> str:
    return with_(merge_changes_ctes(), "SELECT * FROM chg")


def merge_upsert_sql() -> str:
    cols = ", ".join(DIM_COLS)
    return with_(merge_changes_ctes(),
                 f"SELECT {cols} FROM dim0 d WHERE NOT EXISTS (SELECT 1 FROM chg c WHERE "
                 f"c.customer_id = d.customer_id AND c.__rec_version = d.__rec_version)\n"
                 f"UNION ALL SELECT {cols} FROM chg")


def appended_feed_ctes(batches: int, n: int) -> list[str]:
    """The base load and the periodic batches as the feed."""
    cols = ", ".join(CUSTOMER_COLS)
    parts = [f"SELECT {cols}, {EPOCH} AS __ldts FROM ssc WHERE customer_id % 4 = 0"]
    for b in range(1, batches + 1):
        mult = 48271 ** (2 * b + 1) % 2147483647
        bal = (f"CASE WHEN customer_id % 3 = 0 THEN CAST(account_balance_usd + CAST(((customer_id * 31 + {b} * 17) "
               f"% 18447 - 9223) / 100.0 AS DECIMAL(12,2)) AS DECIMAL(12,2)) ELSE account_balance_usd END")
        parts.append(f"SELECT customer_id, name, address, location_id, phone, {bal} AS account_balance_usd, "
                     f"market_segment, comment, {EPOCH} + INTERVAL {10 * b} MINUTE AS __ldts FROM (SELECT * FROM ssc "
                     f"ORDER BY ((customer_id % 2147483647) * {mult}) % 2147483647, customer_id LIMIT {n}) p{b}")
    return [ssc_cte(), "feed AS (\n  " + "\n  UNION ALL\n  ".join(parts) + "\n)"]


def appended_feed_sql(batches: int, n: int) -> str:
    return with_(appended_feed_ctes(batches, n), "SELECT * FROM feed")


def appended_merge_sql(batches: int, n: int) -> str:
    """The appended feed's newest batch merged."""
    out = ", ".join(DIM_COLS)
    return with_(merge_changes_ctes(appended_feed_ctes(batches, n)),
                 f"SELECT {out} FROM dim0 d WHERE NOT EXISTS (SELECT 1 FROM chg c WHERE "
                 f"c.customer_id = d.customer_id AND c.__rec_version = d.__rec_version)\n"
                 f"UNION ALL SELECT {out} FROM chg")


def merge_replay_sql() -> str:
    """Replaying every batch through MERGE = the gap-free history over the MERGE hash."""
    w = "PARTITION BY customer_id ORDER BY __ldts"
    ctes = feed_ctes() + [
        f"h AS (SELECT *, {sql_hash(CUSTOMER_MERGE_HASHED)} AS __t2diff_hash FROM feed)",
        f"k AS (SELECT * FROM (SELECT *, coalesce(lag(__t2diff_hash) OVER ({w}), {NULL_HASH}) AS __prev "
        f"FROM h) WHERE __t2diff_hash <> __prev)",
        f"s AS (SELECT *, lead(__ldts) OVER ({w}) AS __nxt, row_number() OVER ({w}) AS __rn, "
        f"first_value(__ldts) OVER ({w} {FULL}) AS __first FROM k)",
    ]
    return with_(ctes, (
        f"SELECT customer_id, __ldts AS __from_dts, CASE WHEN __nxt IS NULL THEN {HIGH} "
        f"ELSE __nxt - INTERVAL 1 MICROSECOND END AS __to_dts, {', '.join(CUSTOMER_PAYLOAD)}, "
        f"__ldts AS __load_dts, CAST(__rn AS BIGINT) AS __rec_version, (__nxt IS NULL) AS __is_latest, "
        f"__first AS __create_dts, __ldts AS __update_dts, __t2diff_hash, {NULL_HASH} AS __t1diff_hash FROM s"))


# ----------------------------------------------------------------------------
# Star schema.

def loyalty_ctes(early_ids: Sequence[int]) -> list[str]:
    values = ", ".join(f"({int(i)})" for i in early_ids) or "(NULL)"
    early = (f"SELECT CAST(v AS BIGINT), 'Gold', 'early supporter' FROM (VALUES {values}) t(v)"
             if early_ids else "SELECT NULL, NULL, NULL WHERE FALSE")
    return [
        "cust_ord AS (SELECT o.customer_id, sum(o.total_price_usd) AS total_price_usd "
        "FROM m_sales_order o JOIN m_customer c ON o.customer_id = c.customer_id "
        "WHERE c.account_balance_usd > 0 AND c.location_id <> 22 GROUP BY o.customer_id)",
        "ranked AS (SELECT customer_id, dense_rank() OVER (ORDER BY total_price_usd DESC NULLS FIRST) AS lvl "
        "FROM cust_ord)",
        "loy AS (SELECT customer_id, CASE WHEN lvl BETWEEN 1 AND 20 THEN 'Gold' WHEN lvl BETWEEN 21 AND 100 "
        "THEN 'Silver' WHEN lvl BETWEEN 101 AND 400 THEN 'Bronze' END AS level, 'top 400' AS type "
        f"FROM ranked WHERE lvl <= 400 UNION ALL {early})",
        "m_loyalty_customer AS (SELECT CAST(customer_id AS BIGINT) AS customer_id, level, type, "
        "CAST(0 AS BIGINT) AS points_amount, '' AS comment FROM loy)",
    ]


def loyalty_sql(early_ids: Sequence[int]) -> str:
    return with_(star_ctes(["customer", "sales_order"]) + loyalty_ctes(early_ids),
                 "SELECT * FROM m_loyalty_customer")


VIEW_SELECT = """l.line_number, l.sales_order_id, l.part_id, l.supplier_id, l.quantity, l.extended_price_usd,
  l.discount_percent, l.tax_percent, l.return_flag, l.line_status, l.ship_date, l.commit_date, l.receipt_date,
  l.ship_instructions, l.ship_mode, l.comment AS lineitem_comment,
  s.name AS supplier_name, s.address AS supplier_address, s.location_id AS supplier_location_id,
  s.phone AS supplier_phone, s.comment AS supplier_comment,
  ls.name AS supplier_location_name, ls.region_id AS supplier_region_id,
  o.customer_id, o.order_status, o.total_price_usd, o.order_date, o.order_priority, o.clerk, o.ship_priority,
  o.comment,
  c.name AS customer_name, c.address, c.location_id, c.phone, c.account_balance_usd AS customer_account_balance_usd,
  c.market_segment, c.comment AS customer_comment,
  lc.name AS customer_location_name, lc.region_id AS customer_region_id,
  p.name AS part_name, p.manufacturer, p.brand, p.type, p.size_centimeters, p.container, p.comment AS part_comment,
  (y.customer_id IS NOT NULL) AS is_loyalty_customer, y.level AS loyalty_level, y.type AS loyalty_type"""

VIEW_FROM = """m_lineitem l
  LEFT JOIN m_supplier s ON s.supplier_id = l.supplier_id
  LEFT JOIN m_sales_order o ON o.sales_order_id = l.sales_order_id
  LEFT JOIN m_part p ON p.part_id = l.part_id
  LEFT JOIN m_location ls ON s.location_id = ls.location_id
  LEFT JOIN m_customer c ON o.customer_id = c.customer_id
  LEFT JOIN m_location lc ON lc.location_id = c.location_id
  LEFT JOIN {loyalty} y ON y.customer_id = c.customer_id"""

VIEW_TABLES = ["lineitem", "supplier", "sales_order", "part", "location", "customer"]


def view_ctes(early_ids: Sequence[int], trusted: bool) -> list[str]:
    ctes = star_ctes(VIEW_TABLES) + loyalty_ctes(early_ids)
    if trusted:
        # One row per loyalty key: the smallest (level, type), NULLs first.
        ctes.append("m_loyalty_trusted AS (SELECT * FROM m_loyalty_customer QUALIFY row_number() OVER "
                    "(PARTITION BY customer_id ORDER BY level NULLS FIRST, type NULLS FIRST) = 1)")
    ctes.append(f"mart AS (SELECT {VIEW_SELECT}\nFROM "
                + VIEW_FROM.format(loyalty="m_loyalty_trusted" if trusted else "m_loyalty_customer") + ")")
    return ctes


def main_reporting_sql(early_ids: Sequence[int], trusted: bool) -> str:
    return with_(view_ctes(early_ids, trusted), "SELECT * FROM mart")


def ship_mode_sql(early_ids: Sequence[int], trusted: bool, as_of: str = "2024-01-01") -> str:
    agg = f"SELECT DATE '{as_of}' AS as_of_date, ship_mode, CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity"
    if trusted:
        # Trusted keys: no dimension can add or drop a line, so only lineitem is read.
        return with_(star_ctes(["lineitem"]), f"{agg} FROM m_lineitem GROUP BY ship_mode")
    return with_(view_ctes(early_ids, False), f"{agg} FROM mart GROUP BY ship_mode")


def ship_mode_between_sql(early_ids: Sequence[int], trusted: bool, first: str, last: str) -> str:
    agg = "SELECT ship_mode, CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity"
    ctes, table = (star_ctes(["lineitem"]), "m_lineitem") if trusted else (view_ctes(early_ids, False), "mart")
    return with_(ctes, f"{agg} FROM {table} WHERE ship_date BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY ship_mode")


def dim_base_sql() -> str:
    return with_(merge_changes_ctes(), f"SELECT {', '.join(DIM_COLS)} FROM dim0")


def changed_ranges_sql(width: int, altered: int, dropped: int, repeated: int) -> str:
    """Ranges of base-load customers that hold an altered, dropped or repeated row."""
    base = [ssc_cte(), "b AS (SELECT customer_id AS k, customer_id // %d AS r FROM ssc WHERE customer_id %% 4 = 0)" % width]
    return with_(base, (
        f"SELECT CAST(r AS BIGINT) AS range, count(*) AS left_rows, CAST(count(*) - count(*) FILTER (k % {dropped} = 0 AND k % {altered} <> 0) "
        f"+ count(*) FILTER (k % {repeated} = 0 AND NOT (k % {dropped} = 0 AND k % {altered} <> 0)) AS BIGINT) AS right_rows FROM b GROUP BY r "
        f"HAVING count(*) FILTER (k % {altered} = 0 OR k % {dropped} = 0 OR k % {repeated} = 0) > 0"))


def region_report_sql(early_ids: Sequence[int], trusted: bool) -> str:
    agg = ("SELECT customer_region_id, CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity, "
           "CAST(sum(extended_price_usd) AS DECIMAL(38,2)) AS extended_price_usd, "
           "count(*) AS line_count")
    return with_(view_ctes(early_ids, trusted), f"{agg} FROM mart GROUP BY customer_region_id")


def fk_join_sql() -> str:
    return with_(star_ctes(["customer", "location"]),
                 "SELECT c.name AS customer_name FROM m_customer c JOIN m_location l ON c.location_id = l.location_id "
                 "WHERE l.location_id IS NOT NULL AND CAST(l.location_id AS BOOLEAN) IS NOT NULL "
                 "AND l.location_id = 4 ORDER BY customer_name LIMIT 100")


def join_methods_sql(child: str, trusted_fk: bool) -> str:
    ctes = star_ctes([child, "region_main"])
    if trusted_fk:
        body = (f"SELECT 'inner join' AS method, count(*) AS cnt FROM m_{child} WHERE region_id IS NOT NULL\n"
                f"UNION ALL SELECT 'left join no filter', count(*) FROM m_{child}\n"
                f"UNION ALL SELECT 'left join filter', count(*) FROM m_{child} WHERE region_id IS NOT NULL")
    else:
        body = (f"SELECT 'inner join' AS method, count(*) AS cnt FROM m_{child} JOIN m_region_main USING (region_id)\n"
                f"UNION ALL SELECT 'left join no filter', count(*) FROM m_{child} LEFT JOIN m_region_main USING (region_id)\n"
                f"UNION ALL SELECT 'left join filter', count(*) FROM m_{child} c LEFT JOIN m_region_main rm "
                f"ON c.region_id = rm.region_id WHERE rm.region_id IS NOT NULL")
    return with_(ctes, body)


def join_methods_year_sql(year: int, today: str) -> str:
    parts = []
    for y in (year, year + 1):
        parts.append(
            f"SELECT 'inner join' AS method, count(*) AS cnt, CAST({y} AS BIGINT) AS guard_year "
            f"FROM m_location JOIN m_region_main USING (region_id)\n"
            f"UNION ALL SELECT 'left join no filter', count(*), {y} FROM m_location LEFT JOIN m_region_main "
            f"USING (region_id)\n"
            f"UNION ALL SELECT 'left join filter', count(*), {y} FROM m_location c LEFT JOIN m_region_main rm "
            f"ON c.region_id = rm.region_id WHERE rm.region_id IS NOT NULL AND year(DATE '{today}') = {y}")
    return with_(star_ctes(["location", "region_main"]), "\nUNION ALL ".join(parts))


# ----------------------------------------------------------------------------
# Audits.

def audit_ctes(early_ids: Sequence[int]) -> list[str]:
    return (star_ctes() + loyalty_ctes(early_ids) + feed_ctes()
            + ["m_source_system_customer AS (SELECT * FROM ssc)", "m_src_customer AS (SELECT * FROM feed)",
               f"m_dim_customer AS (SELECT * FROM ({_one_line(merge_replay_sql())}) dc)"])


def _one_line(sql: str) -> str:
    return " ".join(sql.split("\n"))


def _cols(key: Sequence[str]) -> str:
    return ", ".join(key)


def not_null_sql(tables: dict[str, TableSpec], early_ids) -> str:
    parts = [f"SELECT '{n}' AS table_name, '{c.name}' AS column_name, "
             f"CAST(count_if({c.name} IS NULL) AS BIGINT) AS violations FROM m_{n}"
             for n, s in tables.items() for c in s.columns if not c.nullable]
    return with_(audit_ctes(early_ids), "\nUNION ALL ".join(parts))


def _key_sql(n: str, key: Sequence[str], with_nulls: bool) -> str:
    has_null = " OR ".join(f"{k} IS NULL" for k in key)
    cols = (f"CAST(count_if(n > 1 AND NOT has_null) AS BIGINT) AS duplicate_keys, "
            f"CAST(coalesce(sum(CASE WHEN n > 1 AND NOT has_null THEN n END), 0) AS BIGINT) AS duplicate_rows")
    if with_nulls:
        cols += ", CAST(coalesce(sum(CASE WHEN has_null THEN n END), 0) AS BIGINT) AS null_keys"
    return (f"SELECT '{n}' AS table_name, '{','.join(key)}' AS key_columns, {cols} FROM "
            f"(SELECT count(*) AS n, ({has_null}) AS has_null FROM m_{n} GROUP BY {_cols(key)}) g")


def primary_key_sql(tables: dict[str, TableSpec], early_ids) -> str:
    parts = [_key_sql(n, s.primary_key, True) for n, s in tables.items() if s.primary_key]
    return with_(audit_ctes(early_ids), "\nUNION ALL ".join(parts))


def unique_sql(tables: dict[str, TableSpec], early_ids) -> str:
    parts = [_key_sql(n, u, False) for n, s in tables.items() for u in s.unique]
    return with_(audit_ctes(early_ids), "\nUNION ALL ".join(parts))


def foreign_key_sql(tables: dict[str, TableSpec], early_ids) -> str:
    parts = []
    for n, s in tables.items():
        for fk in s.foreign_keys:
            if fk.parent not in tables:
                continue
            notnull = " AND ".join(f"{c} IS NOT NULL" for c in fk.columns)
            match = " AND ".join(f"p.{pc} = c.{cc}" for cc, pc in zip(fk.columns, fk.parent_columns))
            parts.append(
                f"SELECT '{n}' AS table_name, '{','.join(fk.columns)}' AS fk_columns, '{fk.parent}' AS parent_table, "
                f"CAST(count(*) AS BIGINT) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows FROM "
                f"(SELECT {_cols(fk.columns)}, count(*) AS n FROM m_{n} WHERE {notnull} GROUP BY {_cols(fk.columns)}) c "
                f"WHERE NOT EXISTS (SELECT 1 FROM m_{fk.parent} p WHERE {match})")
    return with_(audit_ctes(early_ids), "\nUNION ALL ".join(parts))


def _source_cte(n: str, s: TableSpec) -> str:
    cols = ", ".join(f"{c.source} AS {c.name}" for c in s.columns)
    where = f" WHERE {s.where}" if s.where else ""
    return f"src_{n} AS (SELECT {'DISTINCT ' if s.distinct else ''}{cols} FROM {s.source}{where})"


def _count(cond: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def types_sql(sources: dict[str, TableSpec], derived: dict[str, TableSpec], early_ids) -> str:
    parts = []
    for n, s in [*sources.items(), *derived.items()]:
        for c in s.columns:
            if c.max_length is not None:
                parts.append(f"SELECT '{n}' AS table_name, '{c.name}' AS column_name, 'length' AS rule, "
                             f"{_count(f'length(CAST({c.name} AS VARCHAR)) > {c.max_length}')} "
                             f"AS violations FROM src_{n}")
            if c.decimal is not None:
                p, sc = c.decimal
                parts.append(f"SELECT '{n}', '{c.name}', 'precision', "
                             f"{_count(f'{c.name} IS NOT NULL AND TRY_CAST({c.name} AS DECIMAL({p},{sc})) IS NULL')} "
                             f"FROM src_{n}")
                parts.append(f"SELECT '{n}', '{c.name}', 'scale', "
                             f"{_count(f'{c.name} IS NOT NULL AND (TRY_CAST({c.name} AS DECIMAL(38,{sc})) IS NULL OR CAST(TRY_CAST({c.name} AS DECIMAL(38,{sc})) AS DOUBLE) <> {c.name})')} "
                             f"FROM src_{n}")
    return with_(audit_ctes(early_ids) + _type_ctes(sources, derived), "\nUNION ALL ".join(parts))


def _type_ctes(sources, derived) -> list[str]:
    return [*(_source_cte(n, s) for n, s in sources.items()),
            *(f"src_{n} AS (SELECT * FROM m_{n})" for n in derived)]


def constraint_report_sql(tables, sources, early_ids, derived) -> str:
    def body(sql: str) -> str:
        return sql[sql.index("\nSELECT") + 1:] if sql.startswith("WITH") else sql
    nn = body(not_null_sql(tables, early_ids))
    pk = body(primary_key_sql(tables, early_ids))
    uq = body(unique_sql(tables, early_ids))
    fk = body(foreign_key_sql(tables, early_ids))
    ty_body = body(types_sql(sources, derived, early_ids))
    ctes = audit_ctes(early_ids) + _type_ctes(sources, derived)
    return with_(ctes, (
        f"SELECT table_name, 'not_null' AS rule, column_name AS columns, violations FROM ({nn}) a\n"
        f"UNION ALL SELECT table_name, 'primary_key', key_columns, duplicate_rows + null_keys FROM ({pk}) b\n"
        f"UNION ALL SELECT table_name, 'unique', key_columns, duplicate_rows FROM ({uq}) c\n"
        f"UNION ALL SELECT table_name, 'foreign_key', fk_columns || '->' || parent_table, orphan_rows FROM ({fk}) d\n"
        f"UNION ALL SELECT table_name, rule, column_name, violations FROM ({ty_body}) e"))


# ----------------------------------------------------------------------------
# Feeds and conformed tables.

def base_load_sql() -> str:
    return with_([ssc_cte()], f"SELECT {', '.join(CUSTOMER_COLS)}, {EPOCH} AS __ldts FROM ssc "
                              f"WHERE customer_id % 4 = 0")


def change_batch_sql(batch: int, n: int, seed: int) -> str:
    bal = (f"CASE WHEN customer_id % 3 = 0 THEN CAST(account_balance_usd + CAST(((customer_id * 31 + {batch} * 17) "
           f"% 18447 - 9223) / 100.0 AS DECIMAL(12,2)) AS DECIMAL(12,2)) ELSE account_balance_usd END")
    return with_([ssc_cte(),
                  f"picked AS (SELECT * FROM ssc ORDER BY (((customer_id % 2147483647) * 48271 % 2147483647 "
                  f"+ {seed} * 40503) * 48271) % 2147483647, customer_id LIMIT {n})"],
                 f"SELECT customer_id, name, address, location_id, phone, {bal} AS account_balance_usd, "
                 f"market_segment, comment, {EPOCH} + INTERVAL {10 * batch} MINUTE AS __ldts FROM picked")


def change_feed_sql() -> str:
    return with_(feed_ctes(), "SELECT * FROM feed")


def diff_hash_sql() -> str:
    return with_([ssc_cte()], (
        f"SELECT customer_id, {sql_hash(CUSTOMER_T2_TRACKED)} AS t2_hash, "
        f"{sql_hash(CUSTOMER_T2N1_TYPE2)} AS t2n1_type2_hash, {sql_hash(CUSTOMER_T2N1_TYPE1)} AS t2n1_type1_hash, "
        f"{sql_hash(CUSTOMER_MERGE_HASHED)} AS merge_hash FROM ssc"))


def conformed_sql(name: str) -> str:
    return with_(star_ctes([name]), f"SELECT * FROM m_{name}")


__all__ = [n for n in dir() if n.endswith("_sql")] + ["duck_type"]
