"""Declared constraints as data-quality jobs.

Only NOT NULL is enforced by the warehouse the model comes from; keys,
uniqueness and references are declarations that the optimizer may trust. Each
audit here turns a declaration into one distributed pass that returns a small
DataFrame of violation counts (never the violating rows themselves):

* NOT NULL, string length and numeric precision/scale: one aggregate per table
  over all its columns (a single scan, partial aggregation per task);
* PRIMARY KEY / UNIQUE: ``groupBy(key).count()`` — map-side partial counts, so
  a key holding a third of all rows costs one row per task — then one summary;
* FOREIGN KEY: child keys are pre-aggregated (key, rows) before the anti-join
  with the distinct parent keys, so the shuffle carries distinct keys only; where
  keys are whole numbers that lie close together, bitmaps carry a bit a key.

Inputs are ``{name: (spec, DataFrame)}``; ``name`` is the table name reported.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.joins import broadcast_if_small
from dimsmith.functions.keysets import BITMAP_BYTES, bitmaps
from dimsmith.sources.model import TableSpec

Tables = dict[str, tuple[TableSpec, DataFrame]]


class NotNullViolation(ValueError):
    """Rows that break a NOT NULL declaration; ``counts`` has them by column."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("NULL in NOT NULL columns: " + ", ".join(f"{c}: {n} rows" for c, n in counts.items()))
        self.counts = counts


def enforce_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    """Refuse rows with NULL in ``columns``, with a count for each (one aggregate)."""
    if columns:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
        bad = {c: row[c] for c in columns if row[c]}
        if bad:
            raise NotNullViolation(bad)


class UniqueViolation(ValueError):
    """Rows that repeat a key declared unique; ``surplus`` counts those beyond the first."""

    def __init__(self, keys: Sequence[str], surplus: int):
        super().__init__(f"{surplus} rows repeat ({', '.join(keys)})")
        self.surplus = surplus


def enforce_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Refuse rows that repeat ``keys``, with their count (partial aggregation, one number back)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    surplus = counts.agg(F.sum(F.col("__n") - 1)).first()[0]
    if surplus:
        raise UniqueViolation(keys, surplus)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def _long_rows(df: DataFrame, table: str, counts: dict[str, Column], name_col: str) -> DataFrame:
    """One aggregate pass, then one row per counted item."""
    wide = df.agg(*[v.alias(f"c{i}") for i, v in enumerate(counts.values())])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(k).alias(name_col), F.col(f"c{i}").cast("bigint").alias("violations"))
        for i, k in enumerate(counts)]))
    return wide.select(F.lit(table).alias("table_name"), stacked.alias("r")).select(
        "table_name", f"r.{name_col}", "r.violations")


def audit_not_null(tables: Tables) -> DataFrame:
    """(table_name, column_name, violations) for each NOT NULL column."""
    parts = []
    for name, (spec, df) in tables.items():
        cols = [c.name for c in spec.columns if not c.nullable]
        if cols:
            parts.append(_long_rows(df, name, {c: F.count_if(F.col(c).isNull()) for c in cols},
                                    "column_name"))
    return _union(parts)


def _key_summary(df: DataFrame, table: str, key: tuple[str, ...], ignore_null: bool) -> DataFrame:
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    has_null = _any_null(key)
    dup = (F.col("__n") > 1) & ~has_null
    aggs = [F.count_if(dup).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(dup, F.col("__n"))), F.lit(0)).cast("bigint").alias("duplicate_rows")]
    if not ignore_null:
        aggs.append(F.coalesce(F.sum(F.when(has_null, F.col("__n"))), F.lit(0)).cast("bigint")
                    .alias("null_keys"))
    return counts.agg(*aggs).select(F.lit(table).alias("table_name"),
                                    F.lit(",".join(key)).alias("key_columns"), "*")


def audit_primary_key(tables: Tables) -> DataFrame:
    """(table_name, key_columns, duplicate_keys, duplicate_rows, null_keys)."""
    return _union([_key_summary(df, name, spec.primary_key, ignore_null=False)
                   for name, (spec, df) in tables.items() if spec.primary_key])


def audit_unique(tables: Tables) -> DataFrame:
    """(table_name, key_columns, duplicate_keys, duplicate_rows); NULLs never clash."""
    return _union([_key_summary(df, name, u, ignore_null=True)
                   for name, (spec, df) in tables.items() for u in spec.unique])


def audit_foreign_key(tables: Tables, parents: Tables | None = None) -> DataFrame:
    """(table_name, fk_columns, parent_table, orphan_keys, orphan_rows).

    All references of a table with keys of the same types take one pass over it:
    each row fans out into its keys, which are pre-aggregated before the
    anti-join with the parents' keys. A reference to a table that isn't among
    ``parents`` (by default ``tables``) has NULL counts."""
    parts, parents = [], tables if parents is None else parents
    for name, (spec, df) in tables.items():
        together: dict[tuple, list] = {}
        for fk in spec.foreign_keys:
            kinds = tuple(df.schema[c].dataType.simpleString() for c in fk.columns) if fk.parent in parents else None
            together.setdefault(kinds, []).append(fk)
        for kinds, fks in together.items():
            parts.append(_unchecked(df, name, fks) if kinds is None else _orphans(df, name, fks, parents))
    return _union(parts)


def _named(df: DataFrame, table: str, fks, counts: list[tuple[Column, Column]]) -> DataFrame:
    """One row a reference from a one-row frame."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(",".join(fk.columns)).alias("fk_columns"),
                 F.lit(fk.parent).alias("parent_table"), a.cast("bigint").alias("orphan_keys"),
                 b.cast("bigint").alias("orphan_rows")) for fk, (a, b) in zip(fks, counts)]))
    return df.select(rows.alias("r")).select("r.*")


def _unchecked(df: DataFrame, table: str, fks) -> DataFrame:
    """References that nobody can check are reported, not passed over."""
    none = F.lit(None)
    return _named(df.sparkSession.range(1), table, fks, [(none, none)] * len(fks))


def _orphans(df: DataFrame, table: str, fks, tables: Tables) -> DataFrame:
    alias = [f"__k{i}" for i in range(len(fks[0].columns))]

    def keyed(number: int, columns) -> Column:
        return F.struct(F.lit(number).alias("__fk"), *[F.col(c).alias(a) for c, a in zip(columns, alias)])

    child = (df.select(F.explode(F.array(*[keyed(i, fk.columns) for i, fk in enumerate(fks)])).alias("k")).select("k.*")
             .where(~_any_null(alias)).groupBy("__fk", *alias).agg(F.count(F.lit(1)).alias("__n")))
    parents = _union([tables[fk.parent][1].select(keyed(i, fk.parent_columns).alias("k")).select("k.*")
                      for i, fk in enumerate(fks)]).distinct()
    orphans = child.join(parents, ["__fk", *alias], "left_anti")
    own = [F.col("__fk") == i for i in range(len(fks))]
    summary = orphans.agg(*[F.count_if(c).alias(f"k{i}") for i, c in enumerate(own)],
                          *[F.coalesce(F.sum(F.when(c, F.col("__n"))), F.lit(0)).alias(f"r{i}") for i, c in enumerate(own)])
    return _named(summary, table, fks, [(F.col(f"k{i}"), F.col(f"r{i}")) for i in range(len(fks))])


# A bitmap is worth its bytes where it stands for this many keys at least (16 bytes a key).
DENSE_KEYS = BITMAP_BYTES // 16
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def audit_foreign_key_bitmaps(tables: Tables) -> DataFrame:
    """The rows of ``audit_foreign_key``, for whole-number keys by bitmaps.

    Child and parent keys become one bit a key; a bitmap's orphans are the bits
    that uniting it with the parents' bitmap adds. Only where there are some are
    keys themselves shuffled, to count the orphans' rows. Exact: no bit stands
    for two keys. References with other keys, or keys that lie too far apart
    for bitmaps, are audited by the keys themselves."""
    parts = []
    for name, (spec, df) in tables.items():
        packed, other = [], []
        for fk in spec.foreign_keys:
            whole = (fk.parent in tables and len(fk.columns) == 1 and df.schema[fk.columns[0]].dataType.simpleString() in _WHOLE
                     and tables[fk.parent][1].schema[fk.parent_columns[0]].dataType.simpleString() in _WHOLE)
            (packed if whole else other).append(fk)
        if packed:
            parts.append(_packed_orphans(df, name, packed, tables))
        if other:
            parts.append(audit_foreign_key({name: (replace(spec, foreign_keys=tuple(other)), df)}, tables))
    return _union(parts)


def _packed_orphans(df: DataFrame, table: str, fks, tables: Tables) -> DataFrame:
    def keyed(rows: DataFrame, columns) -> DataFrame:
        pairs = [F.struct(F.lit(i).alias("__fk"), F.col(c).cast("bigint").alias("__k")) for i, c in columns]
        return rows.select(F.explode(F.array(*pairs)).alias("k")).select("k.*").where("__k IS NOT NULL")

    child = keyed(df, [(i, fk.columns[0]) for i, fk in enumerate(fks)])
    parents = _union([keyed(tables[fk.parent][1], [(i, fk.parent_columns[0])]) for i, fk in enumerate(fks)])
    size = child.agg(F.approx_count_distinct(F.struct("__fk", "__k")).alias("keys"),
                     F.approx_count_distinct(F.struct("__fk", F.bitmap_bucket_number("__k"))).alias("maps")).first()
    if size["keys"] < DENSE_KEYS * size["maps"]:
        return _orphans(df, table, fks, tables)
    side = [bitmaps(d, "__k", ["__fk"]).withColumn("own", F.when(F.lit(own), F.bitmap_count("bits")).otherwise(F.lit(0)))
            for d, own in ((child, False), (parents, True))]
    united = _union(side).groupBy("__fk", "bucket").agg(
        (F.bitmap_count(F.bitmap_or_agg("bits")) - F.sum("own")).alias("orphans")).where("orphans > 0")
    united = united.checkpoint(eager=True)  # one row a bitmap with orphans; read twice
    few = broadcast_if_small(united.select("__fk", "bucket"))
    near = [d.withColumn("bucket", F.bitmap_bucket_number("__k")).join(few, ["__fk", "bucket"], "left_semi")
            for d in (child, parents)]
    rows = near[0].groupBy("__fk", "__k").agg(F.count(F.lit(1)).alias("__n")).join(
        near[1].select("__fk", "__k").distinct(), ["__fk", "__k"], "left_anti")
    found = united.select("__fk", "orphans", F.lit(0).cast("bigint").alias("__n")).unionByName(
        rows.select("__fk", F.lit(0).cast("bigint").alias("orphans"), "__n"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    summary = found.agg(*[zero(F.sum(F.when(F.col("__fk") == i, F.col("orphans")))).alias(f"k{i}") for i in range(len(fks))],
                        *[zero(F.sum(F.when(F.col("__fk") == i, F.col("__n")))).alias(f"r{i}") for i in range(len(fks))])
    return _named(summary, table, fks, [(F.col(f"k{i}"), F.col(f"r{i}")) for i in range(len(fks))])


def type_checks(spec: TableSpec, source: DataFrame) -> dict[str, Column]:
    """Checks of declared lengths and decimal precision/scale on *source* values
    (before the cast, which would round or fail silently)."""
    checks: dict[str, Column] = {}
    for c in spec.columns:
        v = F.col(c.name)
        if c.max_length is not None:
            checks[f"{c.name}|length"] = F.count_if(F.length(v.cast("string")) > c.max_length)
        if c.decimal is not None:
            p, s = c.decimal
            checks[f"{c.name}|precision"] = F.count_if(v.isNotNull() & v.try_cast(f"decimal({p},{s})").isNull())
            # A plain cast rounds silently; a value that changes under the
            # round trip through decimal(38, s) has more than s decimals.
            # What does not fit decimal(38, s) at all (NaN, overflow) is a violation too.
            held = v.try_cast(f"decimal(38,{s})")
            checks[f"{c.name}|scale"] = F.count_if(v.isNotNull() & (held.isNull() | (held.cast("double") != v)))
    return checks


def source_projection(spec: TableSpec, raw: DataFrame) -> DataFrame:
    """The spec's source expressions, named but not cast."""
    df = raw.where(F.expr(spec.where)) if spec.where else raw
    out = df.select([F.expr(c.source).alias(c.name) for c in spec.columns])
    return out.distinct() if spec.distinct else out


def audit_types(sources: Tables) -> DataFrame:
    """(table_name, column_name, rule, violations) for length/precision/scale."""
    parts = []
    for name, (spec, src) in sources.items():
        checks = type_checks(spec, src)
        if checks:
            rows = _long_rows(src, name, checks, "item")
            parts.append(rows.select(
                "table_name", F.split("item", r"\|")[0].alias("column_name"),
                F.split("item", r"\|")[1].alias("rule"), "violations"))
    return _union(parts)


def not_null_checks(spec: TableSpec) -> dict[str, Column]:
    """Checks of NOT NULL on source values: NULL after the cast to the declared type."""
    return {f"{c.name}|not_null": F.count_if(F.col(c.name).try_cast(c.dtype).isNull())
            for c in spec.columns if not c.nullable}


def audit_columns(sources: Tables) -> DataFrame:
    """(table_name, column_name, rule, violations) of NOT NULL, length, precision and
    scale: one aggregate and one pass a table."""
    parts = []
    for name, (spec, src) in sources.items():
        checks = {**not_null_checks(spec), **type_checks(spec, src)}
        if checks:
            parts.append(_long_rows(src, name, checks, "item").select(
                "table_name", F.split("item", r"\|")[0].alias("column_name"),
                F.split("item", r"\|")[1].alias("rule"), "violations"))
    return _union(parts)


def constraint_report(tables: Tables, sources: Tables) -> DataFrame:
    """Every audit in one table: (table_name, rule, columns, violations).

    ``sources`` has the source values of every table of ``tables``."""
    columns = audit_columns(sources).select("table_name", "rule", F.col("column_name").alias("columns"), "violations")
    pk = audit_primary_key(tables).select("table_name", F.lit("primary_key").alias("rule"),
                                          F.col("key_columns").alias("columns"),
                                          (F.col("duplicate_rows") + F.col("null_keys")).alias("violations"))
    uq = audit_unique(tables).select("table_name", F.lit("unique").alias("rule"),
                                     F.col("key_columns").alias("columns"),
                                     F.col("duplicate_rows").alias("violations"))
    fk = audit_foreign_key(tables).select("table_name", F.lit("foreign_key").alias("rule"),
                                          F.concat_ws("->", "fk_columns", "parent_table").alias("columns"),
                                          F.col("orphan_rows").alias("violations"))
    return _union([columns, pk, uq, fk])
