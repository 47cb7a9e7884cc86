from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.operators import audit_ledger as op
from dimsmith.session import scratch_path
from dimsmith.sources.bucketed import BucketedTable
from dimsmith.sources.model import ForeignKey, TableSpec, col

PARENT = TableSpec("parent", (col("id", "bigint", "id", nullable=False), col("code", "string", "code", max_length=3)),
                   primary_key=("id",), unique=(("code",),))
CHILD = TableSpec("child", (col("k", "bigint", "k"), col("id", "bigint", "id")), primary_key=("k", "id"),
                  foreign_keys=(ForeignKey(("id",), "parent", ("id",)), ForeignKey(("k",), "elsewhere", ("k",))))


def _batch(spark, parent=(), child=()):
    t = {"parent": (PARENT, spark.createDataFrame(list(parent), "id bigint, code string")),
         "child": (CHILD, spark.createDataFrame(list(child), "k bigint, id bigint"))}
    return t, t


def _found(spark, base):
    return {(r.table_name, r.rule, r["columns"]): r.violations for r in op.report(spark, base).collect()}


def test_violations_come_and_go_with_the_batches(spark):
    base = scratch_path(spark, "test-ledger")
    pk, uq, fk = ("parent", "primary_key", "id"), ("parent", "unique", "code"), ("child", "foreign_key", "id->parent")
    op.audit_batch(spark, base, *_batch(spark, [(1, "a")], [(1, 1), (2, 9), (3, 9), (4, None)]), 0, buckets=4)
    first = _found(spark, base)
    assert (first[pk], first[uq], first[fk]) == (0, 0, 2)
    assert first["child", "primary_key", "k,id"] == 1                     # a NULL in the key
    assert first["child", "foreign_key", "k->elsewhere"] is None          # nobody can check it
    op.audit_batch(spark, base, *_batch(spark, [(9, "a"), (1, "long")]), 1)
    second = _found(spark, base)
    assert (second[pk], second[uq], second[fk]) == (2, 2, 0)              # the parent heals, the key and code repeat
    assert second["parent", "length", "code"] == 1
    op.audit_batch(spark, base, *_batch(spark, [(1, None), (None, None)], [(2, 9)]), 2)
    third = _found(spark, base)
    assert (third[pk], third[uq], third[fk]) == (4, 2, 0)
    assert third["parent", "not_null", "id"] == 1 and third["child", "primary_key", "k,id"] == 3
    op.audit_batch(spark, base, *_batch(spark, [(1, None)]), 2)           # repeated
    op.audit_batch(spark, base, *_batch(spark), 3)                        # empty
    assert _found(spark, base) == third


def test_a_batch_writes_the_buckets_of_its_keys(spark):
    base = scratch_path(spark, "test-ledger-buckets")
    op.audit_batch(spark, base, *_batch(spark, [(k, str(k)) for k in range(200)]), 0, buckets=16)
    op.audit_batch(spark, base, *_batch(spark, child=[(1, 7)]), 1)
    written = BucketedTable(spark, base, ["rule", "key"]).pointer.written["ledger"]
    assert 1 <= sum(c == 2 for c in written.values()) <= 2


def test_writer_that_dies_leaves_the_report(spark, monkeypatch):
    from dimsmith.sources.bucketed import Commit
    base = scratch_path(spark, "test-ledger-crash")
    op.audit_batch(spark, base, *_batch(spark, [(1, "a")]), 0, buckets=2)
    before = _found(spark, base)
    for step in ("append", "publish"):
        with monkeypatch.context() as m:
            m.setattr(Commit, step, lambda *_, **__: (_ for _ in ()).throw(RuntimeError("died")))
            with pytest.raises(RuntimeError):
                op.audit_batch(spark, base, *_batch(spark, [(1, "b")]), 1)
        assert _found(spark, base) == before
    op.audit_batch(spark, base, *_batch(spark, [(1, "b")]), 1)
    assert _found(spark, base)["parent", "primary_key", "id"] == 2


def test_a_batch_is_not_stored_before_it_is_added(spark, monkeypatch):
    """Its rows go straight into the aggregate with the ledger's, whichever buckets they touch."""
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *_, **__: (_ for _ in ()).throw(AssertionError("stored")))
    base = scratch_path(spark, "test-ledger-direct")
    op.audit_batch(spark, base, *_batch(spark, [(k, str(k)) for k in range(50)], [(1, 70)]), 0, buckets=16)
    op.audit_batch(spark, base, *_batch(spark, [(70, "7")], [(1, 70)]), 1)
    found = _found(spark, base)
    assert found["child", "foreign_key", "id->parent"] == 0 and found["child", "primary_key", "k,id"] == 2
    assert found["parent", "unique", "code"] == 2


def test_buckets_that_the_first_rows_miss_are_found(spark, monkeypatch):
    monkeypatch.setattr(op, "FIRST_ROWS", 1)
    base = scratch_path(spark, "test-ledger-first-rows")
    rows = [(k, str(k)) for k in range(100)]
    op.audit_batch(spark, base, *_batch(spark, rows), 0, buckets=16)
    op.audit_batch(spark, base, *_batch(spark, rows), 1)
    assert _found(spark, base)["parent", "primary_key", "id"] == 200
    assert BucketedTable(spark, base, ["rule", "key"]).read("ledger").count() == 300   # key, code, parent of child


def test_keys_of_every_type_are_a_json_list_of_texts(spark):
    """Plain or escaped, the text is that of ledgers written before."""
    df = spark.sql("""SELECT * FROM VALUES (1L, 2S, 1.50BD, DATE'2024-01-02', TIMESTAMP_NTZ'2024-01-02 03:04:05.1', true, 'a"b\\\\c', 1.5D),
                      (NULL, 2S, NULL, NULL, NULL, NULL, NULL, NULL), (-7L, 0S, -0.01BD, DATE'0001-01-01', TIMESTAMP_NTZ'1999-12-31 00:00:00', false, '","', double('nan'))
                      AS t(a, b, c, d, e, f, g, h)""")
    for columns in (("a",), ("a", "b"), ("c", "d", "e", "f"), ("a", "g"), ("g",), ("h", "a")):
        whole = F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))
        want = F.when(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns]), whole)
        got = df.select(op._key(df, columns).alias("got"), want.alias("want")).collect()
        assert [r.got for r in got] == [r.want for r in got] and got[0].got and got[1].got is None
