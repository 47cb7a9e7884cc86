"""Trusted-key star schema: reporting mart, join pruning, trust modes.

Trust modes, named in every API:

``'none'``      the control: every join is a real join.
``'declared'``  keys are assumed true without checking (``RELY``). A left join
                to a dimension on its trusted key cannot add or remove fact rows,
                so when none of its columns is read it is dropped; an inner join
                on a trusted foreign key becomes ``fk IS NOT NULL``. If a declared
                key is false, the answer is wrong, by definition of trust.
``'verified'``  keys are checked first (duplicates / orphans); checked keys are
                trusted, failing ones fall back to real joins.

Two ways to get left-join pruning:

* ``trusted_dim(df, key)`` groups the dimension by its key. Catalyst then knows
  the key is distinct and removes an outer join whose columns are never read,
  including the dedup itself. Duplicate keys collapse to one deterministic row
  (the smallest by the remaining columns). Best for a view queried later.
* ``columns=[...]`` joins only the dimensions the requested columns need. Under
  ``declared`` those are wrapped too, so the answer is that of the whole view;
  under ``verified`` every dimension's key is checked first, one that fails is
  joined as it is whether read or not, and the others join without dedup.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.joins import broadcast_if_small
from dimsmith.sources.model import TableSpec, conformed_columns, raw_columns

TRUST_MODES = ("none", "declared", "verified")


def trust_of(spec, verify: bool = False) -> str:
    """Trust mode from a table's declaration: RELY -> ``'declared'`` (or
    ``'verified'`` when asked to check), no RELY -> ``'none'``."""
    if not spec.trusted:
        return "none"
    return "verified" if verify else "declared"


def _check_trust(trust: str) -> None:
    if trust not in TRUST_MODES:
        raise ValueError(f"trust must be one of {TRUST_MODES}, got {trust!r}")


def trusted_dim(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``df`` with its key made provably unique (one row per key)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    grouped = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return grouped.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def key_is_unique(df: DataFrame, key: str | Sequence[str]) -> bool:
    """True if no key value repeats and no key column is NULL (one action)."""
    keys = [key] if isinstance(key, str) else list(key)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    bad = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
           .where((F.col("n") > 1) | any_null))
    return bad.limit(1).count() == 0


def orphan_free(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> bool:
    """True if every non-NULL ``child.fk`` exists in ``parent.pk`` (one action)."""
    keys = child.where(F.col(fk).isNotNull()).select(F.col(fk).alias("__k")).distinct()
    orphans = keys.join(parent.select(F.col(pk).alias("__k")), "__k", "left_anti")
    return orphans.limit(1).count() == 0


# ----------------------------------------------------------------------------
# Wide reporting mart: lineitem with seven left joins (two roles of location).

# Output column names of the reporting view, in view order
# (16 line columns, then supplier, orders, customer, part and loyalty ones).
LINE_COLUMNS = ("line_number", "sales_order_id", "part_id", "supplier_id", "quantity",
                "extended_price_usd", "discount_percent", "tax_percent", "return_flag",
                "line_status", "ship_date", "commit_date", "receipt_date",
                "ship_instructions", "ship_mode")


def _dimensions(star: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, str, str, tuple[str, ...]]]:
    """name -> (projected dimension, its key column, fact-side column, needs)."""
    loc = star["location"]
    return {
        "supplier": (star["supplier"].select(
            F.col("supplier_id").alias("__sup_key"), F.col("name").alias("supplier_name"),
            F.col("address").alias("supplier_address"), F.col("location_id").alias("supplier_location_id"),
            F.col("phone").alias("supplier_phone"), F.col("comment").alias("supplier_comment")),
            "__sup_key", "supplier_id", ()),
        "sales_order": (star["sales_order"].select(
            F.col("sales_order_id").alias("__so_key"), "customer_id", "order_status", "total_price_usd",
            "order_date", "order_priority", "clerk", "ship_priority", "comment"),
            "__so_key", "sales_order_id", ()),
        "part": (star["part"].select(
            F.col("part_id").alias("__p_key"), F.col("name").alias("part_name"), "manufacturer", "brand",
            "type", "size_centimeters", "container", F.col("comment").alias("part_comment")),
            "__p_key", "part_id", ()),
        "supplier_location": (loc.select(
            F.col("location_id").alias("__locs_key"), F.col("name").alias("supplier_location_name"),
            F.col("region_id").alias("supplier_region_id")),
            "__locs_key", "supplier_location_id", ("supplier",)),
        "customer": (star["customer"].select(
            F.col("customer_id").alias("__c_key"), F.col("name").alias("customer_name"), "address",
            "location_id", "phone", F.col("account_balance_usd").alias("customer_account_balance_usd"),
            "market_segment", F.col("comment").alias("customer_comment")),
            "__c_key", "customer_id", ("sales_order",)),
        "customer_location": (loc.select(
            F.col("location_id").alias("__locc_key"), F.col("name").alias("customer_location_name"),
            F.col("region_id").alias("customer_region_id")),
            "__locc_key", "location_id", ("customer",)),
        "loyalty": (star["loyalty_customer"].select(
            F.col("customer_id").alias("__loy_key"), F.col("level").alias("loyalty_level"),
            F.col("type").alias("loyalty_type")),
            "__loy_key", "__c_key", ("customer",)),
    }


ALL_DIMENSIONS = ("supplier", "sales_order", "part", "supplier_location", "customer",
                  "customer_location", "loyalty")

VIEW_COLUMNS = (LINE_COLUMNS + ("lineitem_comment", "supplier_name", "supplier_address",
                "supplier_location_id", "supplier_phone", "supplier_comment",
                "supplier_location_name", "supplier_region_id", "customer_id", "order_status",
                "total_price_usd", "order_date", "order_priority", "clerk", "ship_priority",
                "comment", "customer_name", "address", "location_id", "phone",
                "customer_account_balance_usd", "market_segment", "customer_comment",
                "customer_location_name", "customer_region_id", "part_name", "manufacturer",
                "brand", "type", "size_centimeters", "container", "part_comment",
                "is_loyalty_customer", "loyalty_level", "loyalty_type"))


def _needed_dimensions(columns: Sequence[str], dims) -> set[str]:
    owner = {}
    for name, (df, key, _, _) in dims.items():
        for c in df.columns:
            if c != key:
                owner[c] = name
    owner["is_loyalty_customer"] = "loyalty"
    return _with_needs({owner[c] for c in columns if c in owner}, dims)


def _with_needs(names: set[str], dims) -> set[str]:
    """The dimensions and those that their join columns come from."""
    need: set[str] = set()
    stack = list(names)
    while stack:
        d = stack.pop()
        if d not in need:
            need.add(d)
            stack.extend(dims[d][3])
    return need


def main_reporting(star: dict[str, DataFrame], trust: str = "none", columns: Sequence[str] | None = None,
                   lines: tuple[TableSpec, DataFrame] | None = None) -> DataFrame:
    """The 50-column reporting view at lineitem grain.

    ``star`` holds the conformed tables (``lineitem``, ``supplier``,
    ``sales_order``, ``part``, ``location``, ``customer``, ``loyalty_customer``).
    With ``columns`` given and trust not ``'none'``, only the dimensions those
    columns need are joined, and those whose key proves false. Otherwise all
    seven are joined; under trust they are wrapped in ``trusted_dim`` so
    Catalyst drops unread ones.

    A caller that reads the whole view gives the lines as they are stored,
    ``lines=(spec, raw rows)``, instead of ``star["lineitem"]``: they travel with
    their raw columns and are conformed after the joins, so no shuffle carries
    derived columns, and the supplier is measured for a broadcast.
    """
    _check_trust(trust)
    dims = _dimensions(star)
    if lines is None:
        line = star["lineitem"].select(*LINE_COLUMNS, F.col("comment").alias("lineitem_comment"))
        of_line = {}
    else:
        spec, raw = lines
        if spec.distinct:
            raise ValueError(f"{spec.name} is distinct over its columns and can't be conformed after the joins")
        line = (raw.where(F.expr(spec.where)) if spec.where else raw).select(*raw_columns(spec, raw))
        of_line = dict(zip(spec.column_names, conformed_columns(spec)))
        of_line["lineitem_comment"] = of_line.pop("comment").alias("lineitem_comment")
    wanted = list(columns) if columns is not None else list(VIEW_COLUMNS)
    unknown = [c for c in wanted if c not in VIEW_COLUMNS]
    if unknown:
        raise ValueError(f"not columns of the reporting view: {unknown}")

    if columns is not None and trust == "declared":
        use = _needed_dimensions(wanted, dims)
        wrap = {d: True for d in use}
    elif columns is not None and trust == "verified":
        false = {d for d in dims if not key_is_unique(dims[d][0], dims[d][1])}
        use = _with_needs(_needed_dimensions(wanted, dims) | false, dims)
        wrap = {d: False for d in use}
    else:
        use = set(ALL_DIMENSIONS)
        if trust == "declared":
            wrap = {d: True for d in use}
        elif trust == "verified":
            wrap = {d: key_is_unique(dims[d][0], dims[d][1]) for d in use}
        else:
            wrap = {d: False for d in use}

    def dim(name: str) -> DataFrame:
        df, key, _, _ = dims[name]
        return trusted_dim(df, key) if wrap[name] else df

    def attach(left: DataFrame, names: Sequence[str], right: dict[str, DataFrame] | None = None) -> DataFrame:
        for name in names:
            if name in use:
                _, key, fact_col, _ = dims[name]
                other = right[name] if right and name in right else dim(name)
                left = left.join(other, of_line.get(fact_col, F.col(fact_col)) == F.col(key), "left")
        return left

    # Left joins re-associated; exactly equivalent because each join condition
    # reads only its own branch. Location and loyalty are joined at customer
    # grain, the customer branch at order grain, the order branch last: wide
    # rows are never shuffled by the customer key, and orders meet the customer
    # key once. Lines meet part while they are narrow, since the shuffle by the
    # other key carries what the first join added. The supplier branch stays at
    # line grain: its location is a tiny broadcast either way, and a pre-joined
    # branch would hide the supplier table's own size from the planner (join
    # estimates multiply).
    right = {}
    if "customer" in use:
        right["customer"] = attach(dim("customer"), ["customer_location", "loyalty"])
    if "sales_order" in use:
        right["sales_order"] = attach(dim("sales_order"), ["customer"], right)
    suppliers = ["supplier", "supplier_location"]
    if lines is None:
        view = attach(line, [*suppliers, "part", "sales_order"], right)
    else:
        # Part is joined by merge at every size (the planner would judge it by its
        # compressed file). A supplier table of known size is broadcast, and then
        # no shuffle carries its columns.
        supplier = dim("supplier") if "supplier" in use else None
        if "part" in use:
            right["part"] = dim("part").hint("merge")
        if supplier is not None:
            right["supplier"] = broadcast_if_small(supplier)
        held = supplier is not None and right["supplier"] is not supplier
        first, last = ([], suppliers) if held else (suppliers, [])
        view = attach(line, [*first, "part", "sales_order", *last], right)

    select = []
    for c in wanted:
        if c == "is_loyalty_customer":
            select.append((F.col("__loy_key").isNotNull() if "loyalty" in use else F.lit(False)).alias(c))
        else:
            select.append(of_line.get(c, F.col(c)))
    return view.select(*select)


def ship_mode_report(view: DataFrame, as_of_date: str = "2024-01-01") -> DataFrame:
    """Quantity by ship mode, stamped with a report date (a parameter, not the clock)."""
    return (view.groupBy(F.lit(as_of_date).cast("date").alias("as_of_date"), "ship_mode")
            .agg(F.sum("quantity").cast("decimal(38,2)").alias("quantity")))


def report_by_customer_region(view: DataFrame) -> DataFrame:
    """Partial use of the mart: reads only the customer-location role."""
    return (view.groupBy("customer_region_id")
            .agg(F.sum("quantity").cast("decimal(38,2)").alias("quantity"),
                 F.sum("extended_price_usd").cast("decimal(38,2)").alias("extended_price_usd"),
                 F.count(F.lit(1)).alias("line_count")))


def create_reporting_function(spark, star: dict[str, DataFrame], name: str = "reporting") -> None:
    """The reporting view as a SQL table function ``name(trusted, first, last)``.

    ``trusted`` chooses between declared and untrusted keys, the dates bound
    ``ship_date``. Arguments are constants to the optimizer: the branch that was
    not chosen vanishes, unread joins of the chosen one do, and the dates reach
    the scan.
    """
    views = {}
    for trust in ("declared", "none"):
        views[trust] = f"{name}_{trust}_keys"
        main_reporting(star, trust=trust).createOrReplaceTempView(views[trust])
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.table(views["declared"]).schema)
    dated = "ship_date BETWEEN first AND last"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(trusted BOOLEAN, first DATE, last DATE) RETURNS TABLE({columns}) "
              f"RETURN SELECT * FROM {views['declared']} WHERE trusted AND {dated} "
              f"UNION ALL SELECT * FROM {views['none']} WHERE NOT trusted AND {dated}")


def eager_region_report(star: dict[str, DataFrame], trust: str = "declared") -> DataFrame:
    """The customer-region report with the sums taken before the joins.

    A left join repeats a line once for each match of its order, so summing the
    lines of an order first and joining the sums gives the same report. Lines
    are summed by order (before they are shuffled, so about one row an order
    travels), the sums joined to the orders, summed again by customer, and only
    those meet the customer branch. Lines are never shuffled by the customer
    key, and no row wider than the sums is.

    Under ``'declared'`` keys are assumed true and nothing else is joined. Under
    ``'verified'`` dimensions whose key proves false are joined where they hang
    (supplier and part to the lines, loyalty to the customers), so their
    repeats count as in the view.
    """
    _check_trust(trust)
    if trust == "none":
        raise ValueError("sums can move below the joins only where keys are declared or verified")
    dims = _dimensions(star)
    false = {d for d in dims if not key_is_unique(dims[d][0], dims[d][1])} if trust == "verified" else set()
    use = _with_needs({"customer_location"} | false, dims)

    def attach(left: DataFrame, names: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
        for name in names:
            if name in use:
                df, key, fact_col, _ = dims[name]
                read = [c for c in df.columns if c == key or c in columns]
                left = left.join(df.select(*read), F.col(fact_col) == F.col(key), "left")
        return left

    def summed(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(F.sum("quantity").alias("quantity"), F.sum("extended_price_usd").alias("extended_price_usd"),
                                   F.sum("line_count").alias("line_count"))

    line = attach(star["lineitem"].select("sales_order_id", "supplier_id", "part_id", "quantity", "extended_price_usd"),
                  ["supplier", "supplier_location", "part"], ["supplier_location_id"])
    by_order = summed(line.withColumn("line_count", F.lit(1).cast("long")), "sales_order_id")
    by_customer = summed(attach(by_order, ["sales_order"], ["customer_id"]), "customer_id")
    regions = attach(by_customer, ["customer", "customer_location", "loyalty"], ["location_id", "customer_region_id"])
    out = summed(regions, "customer_region_id")
    money = [F.col(c).cast("decimal(38,2)").alias(c) for c in ("quantity", "extended_price_usd")]
    return out.select("customer_region_id", *money, "line_count")


# ----------------------------------------------------------------------------
# Inner joins on trusted foreign keys (J8) and the join-method experiment.

def fk_join(child: DataFrame, parent: DataFrame, fk: str, pk: str, *,
            parent_columns: Sequence[str] = (), key_filter: Callable[[Column], Column] | None = None,
            trust: str = "declared", fk_declared: bool = True, prefix: str = "parent_") -> DataFrame:
    """Inner join ``child.fk = parent.pk`` keeping child rows (+ ``parent_columns``).

    With a trusted FK and only the parent key read, every non-NULL child key
    has exactly one parent, so the join is replaced by ``fk IS NOT NULL`` and
    predicates on the parent key move onto the child key. Catalyst does not do
    this rewrite itself (it cannot see foreign keys).
    """
    _check_trust(trust)
    reads_only_key = all(c == pk for c in parent_columns)
    prune = trust != "none" and fk_declared and reads_only_key
    if prune and trust == "verified":
        prune = key_is_unique(parent.select(pk), pk) and orphan_free(child, parent, fk, pk)
    if prune:
        cond = F.col(fk).isNotNull()
        if key_filter is not None:
            cond = cond & key_filter(F.col(fk))
        out = child.where(cond)
        return out.withColumns({f"{prefix}{c}": F.col(fk) for c in parent_columns}) if parent_columns else out
    p = parent.select(F.col(pk).alias("__pk"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in parent_columns])
    if key_filter is not None:
        p = p.where(key_filter(F.col("__pk")))
    return child.join(p, F.col(fk) == F.col("__pk"), "inner").drop("__pk")


def left_join_keep(child: DataFrame, parent: DataFrame, key: str, trust: str) -> DataFrame:
    """``child LEFT JOIN parent USING (key)`` reading child columns only."""
    p = parent.select(key)
    if trust == "declared" or (trust == "verified" and key_is_unique(p, key)):
        p = trusted_dim(p, key)
    return child.join(p, [key], "left")


def join_method_counts(child: DataFrame, parent: DataFrame, key: str, trust: str = "none",
                       fk_declared: bool = False, as_of_year: int | None = None,
                       today: str | None = None) -> DataFrame:
    """Rows of ``child`` joined to ``parent`` USING(``key``) three ways:
    inner, left without filter, and left with ``parent.key IS NOT NULL``.

    ``as_of_year``/``today`` reproduce a date predicate that only guards a
    result cache; by default it is left out (it is constant for a given day).
    """
    _check_trust(trust)
    c = child.select(key)
    inner = fk_join(c, parent, key, key, trust=trust, fk_declared=fk_declared)
    left = left_join_keep(c, parent, key, trust)
    # Left join plus a null-rejecting filter on the parent side is an inner join.
    if trust == "none":
        pk = parent.select(key, F.col(key).alias("__rk"))
        left_filter = c.join(pk, [key], "left").where(F.col("__rk").isNotNull())
    else:
        left_filter = fk_join(c, parent, key, key, trust=trust, fk_declared=fk_declared)
    if as_of_year is not None:
        day = F.lit(today).cast("date") if today else F.current_date()
        left_filter = left_filter.where(F.year(day) == F.lit(as_of_year))

    def count(df: DataFrame, method: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(method).alias("method"), "cnt")

    return (count(inner, "inner join")
            .unionByName(count(left, "left join no filter"))
            .unionByName(count(left_filter, "left join filter")))
