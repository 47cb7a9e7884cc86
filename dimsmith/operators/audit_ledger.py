"""Constraint audit maintained batch by batch.

For each key rule the ledger counts, by key, the rows that own the key and the
rows that it may refer to:

* PRIMARY KEY, UNIQUE: rows with the key; all rows of a repeated key violate
  (for a primary key also rows with a NULL in it);
* FOREIGN KEY: rows that refer to the key, and parent rows that have it; all
  rows of a key without a parent violate. A parent that arrives later heals
  them, whichever batch it comes in.

Counts of batches add up, so a batch is added to the ledger's rows of its keys in
one aggregate with map-side partial counts over all its rules: a
``BucketedTable``, of which only the touched buckets are read and written. The change of each rule's violations is the difference over those keys.
Column rules (NOT NULL, length, precision, scale) are plain counts and are added
as they are. The report sums the changes of all batches: no table is read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.operators.constraints import Tables, audit_columns
from dimsmith.sources.bucketed import BucketedTable
from dimsmith.sources.model import TableSpec

LEDGER, CHANGES = "ledger", "changes"
# Types whose text has nothing that JSON escapes.
PLAIN = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
# Rows of a table by which a batch is tried for touching every bucket.
FIRST_ROWS = 1000
PRIMARY, UNIQUE, FOREIGN = "primary_key", "unique", "foreign_key"


@dataclass(frozen=True)
class Rule:
    """A key rule of a table; ``parent`` and ``parent_columns`` of a reference."""

    number: int
    table: str
    kind: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        names = ",".join(self.columns)
        return f"{names}->{self.parent}" if self.kind == FOREIGN else names


def rules_of(specs: dict[str, TableSpec]) -> list[Rule]:
    """The key rules of a model, numbered in a fixed order."""
    found = []
    for name, spec in specs.items():
        if spec.primary_key:
            found.append((name, PRIMARY, tuple(spec.primary_key)))
        found += [(name, UNIQUE, tuple(u)) for u in spec.unique]
        found += [(name, FOREIGN, tuple(fk.columns), fk.parent, tuple(fk.parent_columns)) for fk in spec.foreign_keys]
    return [Rule(n, *r) for n, r in enumerate(found)]


def _key(df: DataFrame, columns) -> Column:
    """The key as text, the same for owner and parent; NULL if a column is.

    A JSON list of the columns as strings. Values whose text needs no escapes
    (all but strings and binaries) are put between the quotes as they are."""
    plain = all(isinstance(df.schema[c].dataType, PLAIN) for c in columns)
    texts = [F.col(c).cast("string") for c in columns]
    if plain:
        return F.concat(F.lit('["'), *[x for t in texts for x in (t, F.lit('","'))][:-1], F.lit('"]'))
    whole = F.to_json(F.array(*texts))
    return F.when(F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0)) == 0, whole)


def key_rows(tables: Tables, rules: list[Rule]) -> DataFrame:
    """(rule, key, own, other): a row for each key that a row has. A table takes one pass for all its rules."""
    out = None
    for name, (_, df) in tables.items():
        roles = [(r.number, r.kind, r.columns, 1, 0) for r in rules if r.table == name and (r.kind != FOREIGN or r.parent in tables)]
        roles += [(r.number, r.kind, r.parent_columns, 0, 1) for r in rules if r.kind == FOREIGN and r.parent == name]
        if not roles:
            continue
        held = F.array(*[F.struct(F.lit(n).alias("rule"), _key(df, cols).alias("key"), F.lit(own).cast("bigint").alias("own"),
                                  F.lit(other).cast("bigint").alias("other"), F.lit(kind == PRIMARY).alias("nulls"))
                         for n, kind, cols, own, other in roles])
        rows = df.select(F.explode(held).alias("r")).select("r.*").where("key IS NOT NULL OR nulls").drop("nulls")
        out = rows if out is None else out.unionByName(rows)
    return out


def _touched(table: BucketedTable, batch: Tables, rules: list[Rule]) -> list[int]:
    """Buckets of the batch's keys. A few rows of each table that touch all buckets already settle it."""
    few = table.buckets_of(key_rows({n: (spec, df.limit(FIRST_ROWS)) for n, (spec, df) in batch.items()}, rules))
    return few if len(few) == table.pointer.buckets else table.buckets_of(key_rows(batch, rules))


def _violations(rules: list[Rule], own: Column, other: Column) -> Column:
    """Rows that violate their rule, of one key."""
    foreign = F.col("rule").isin([r.number for r in rules if r.kind == FOREIGN])
    return (F.when(F.col("key").isNull(), own)
            .when(foreign, F.when(other == 0, own).otherwise(0))
            .otherwise(F.when(own > 1, own).otherwise(0)))


def _labelled(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.number, r.table, r.kind, r.label) for r in rules]
    return spark.createDataFrame(rows, "rule int, table_name string, kind string, columns string")


def audit_batch(spark: SparkSession, base: str, batch: Tables, sources: Tables, batch_id: int,
                buckets: int | None = None, stream: str = "default") -> None:
    """Add one batch of rows of the model's tables to the audit kept under ``base``.

    ``batch`` has all tables of the model (those without new rows empty),
    ``sources`` their source values before the cast. A repeated batch is left out.
    """
    table = BucketedTable(spark, base, ["rule", "key"], buckets)
    done = table.pointer.streams.get(stream)
    if done is not None and done >= batch_id:
        return
    rules = rules_of({n: spec for n, (spec, _) in batch.items()})
    commit = table.begin()
    touched = _touched(table, batch, rules)
    zero = F.lit(0).cast("bigint")
    # The batch's rows and the ledger's meet in one aggregate, with partial counts before its shuffle.
    rows = key_rows(batch, rules).select("rule", "key", zero.alias("own"), zero.alias("other"), F.col("own").alias("d_own"), F.col("other").alias("d_other"))
    held = table.read(LEDGER, touched)
    if held is not None:
        rows = rows.unionByName(held.select("rule", "key", "own", "other", zero.alias("d_own"), zero.alias("d_other")))
    both = rows.groupBy("rule", "key").agg(*[F.sum(c).alias(c) for c in ("own", "other", "d_own", "d_other")])
    own, other = F.col("own") + F.col("d_own"), F.col("other") + F.col("d_other")
    change = _violations(rules, own, other) - _violations(rules, F.col("own"), F.col("other"))
    commit.rewrite(LEDGER, both.select("rule", "key", own.alias("own"), other.alias("other"), change.alias("change")), touched)
    written = commit.written(LEDGER)
    checked = [r for r in rules if r.kind != FOREIGN or r.parent in batch]
    changes = _labelled(spark, checked).withColumn("violations", zero)
    if written is not None:
        sums = written.groupBy("rule").agg(F.sum("change").alias("violations"))
        changes = changes.unionByName(_labelled(spark, checked).join(F.broadcast(sums), "rule"))  # one row a rule
    unchecked = [r for r in rules if r not in checked]
    if unchecked:
        changes = changes.unionByName(_labelled(spark, unchecked).withColumn("violations", F.lit(None).cast("bigint")))
    columns = audit_columns(sources).select("table_name", "rule", F.col("column_name").alias("columns"), "violations")
    keys = changes.select("table_name", F.col("kind").alias("rule"), "columns", "violations")
    commit.append(CHANGES, keys.unionByName(columns)).stream(stream, batch_id).publish()


def report(spark: SparkSession, base: str) -> DataFrame:
    """Every rule's violations by now: (table_name, rule, columns, violations)."""
    changes = BucketedTable(spark, base, ["rule", "key"]).read_appended(CHANGES)
    return changes.groupBy("table_name", "rule", "columns").agg(F.sum("violations").alias("violations"))
