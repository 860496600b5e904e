"""The slice table: atomic change, deletion, conflicts, crashes, and refreshes of what changed."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_rollup import FACT, sale, star  # noqa: F401

from salescube.operators import checks
from salescube.operators.fingerprint import marks, table_mark
from salescube.plans import rollup
from salescube.sources.slices import Conflict, SliceTable

SCHEMA = T.StructType([T.StructField("day", T.DateType()), T.StructField("shop", T.StringType()), T.StructField("value", T.LongType())])
D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def content(table, version=None):
    return sorted(tuple(r) for r in table.read(version).collect())


@pytest.fixture
def table(spark, tmp_path):
    made = SliceTable(spark, str(tmp_path / "a table"), ["day", "shop"], SCHEMA)
    made.replace(rows(spark, (D1, "a b", 1), (D1, "é/ü=%", 2), (D2, "a b", 3)))
    return made


def test_replace_delete_and_old_versions(spark, table):
    assert table.replace(rows(spark, (D1, "a b", 10), (D1, "a b", 11)), [(D1, "a b"), (D2, "a b")], may_be_empty=[(D2, "a b")]) == 2
    assert content(table) == [(D1, "a b", 10), (D1, "a b", 11), (D1, "é/ü=%", 2)]
    assert content(table, 1) == [(D1, "a b", 1), (D1, "é/ü=%", 2), (D2, "a b", 3)]
    assert [r.value for r in table.read(slices=[(D1, "é/ü=%")]).collect()] == [2]
    assert table.manifest().slices[D1, "a b"].rows == 2
    assert table.delete([(D1, "a b"), (D1, "é/ü=%"), (D2, "nowhere")]) == 3
    assert content(table) == [] and table.read().schema == SCHEMA
    assert table.delete([(D1, "a b")]) == 3


def test_refusals_change_nothing(spark, table):
    for bad, options, said in (
        (rows(spark), {}, "empty"),
        (rows(spark, (D1, "x", 1)), {"requested": [(D1, "a b")], "may_be_empty": True}, "not requested: 2024-01-01, x"),
        (rows(spark, (D1, "a b", 1)), {"requested": [(D1, "a b"), (D2, "a b")]}, "would keep their old ones: 2024-02-01, a b"),
    ):
        with pytest.raises(checks.InputError, match=said):
            table.replace(bad, **options)
    assert table.versions() == [1] and len(os.listdir(f"{table.path}/data")) == 1


def test_a_job_that_dies_before_the_rename_changes_nothing(spark, table, monkeypatch):
    before = content(table)
    monkeypatch.setattr(SliceTable, "_publish", lambda self, manifest: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.replace(rows(spark, (D1, "a b", 99)))
    monkeypatch.undo()
    assert content(table) == before and table.versions() == [1]
    assert len(os.listdir(f"{table.path}/data")) == 2
    assert table.vacuum() == 1 and content(table) == before


def test_a_reader_that_began_before_sees_the_old_slices(spark, table):
    begun = table.read()
    table.replace(rows(spark, (D1, "a b", 99), (D2, "a b", 98)))
    assert sorted(r.value for r in begun.collect()) == [1, 2, 3]
    assert sorted(r.value for r in table.read().collect()) == [2, 98, 99]


def test_two_jobs_at_once(spark, table, monkeypatch):
    """The second to finish goes on top of the first, unless both change one slice."""
    write, other = SliceTable._write, SliceTable(spark, table.path, table.keys, SCHEMA)

    def beside(self, result, folder, change):
        monkeypatch.setattr(SliceTable, "_write", write)
        change()
        return write(self, result, folder)

    monkeypatch.setattr(SliceTable, "_write", lambda s, r, f: beside(s, r, f, lambda: other.replace(rows(spark, (D2, "a b", 30)))))
    table.replace(rows(spark, (D1, "a b", 10)))
    assert content(table) == [(D1, "a b", 10), (D1, "é/ü=%", 2), (D2, "a b", 30)] and table.versions() == [1, 2, 3]
    monkeypatch.setattr(SliceTable, "_write", lambda s, r, f: beside(s, r, f, lambda: other.delete([(D1, "a b")])))
    with pytest.raises(Conflict):
        table.replace(rows(spark, (D1, "a b", 11)))
    assert content(table) == [(D1, "é/ü=%", 2), (D2, "a b", 30)]
    assert not table._publish(table.manifest())  # its version exists


def test_vacuum_keeps_what_kept_versions_list(spark, table):
    for value in range(4):
        table.replace(rows(spark, (D1, "a b", value)))
    assert table.vacuum(keep=2) == 2 and table.versions() == [4, 5]
    assert content(table, 4) == [(D1, "a b", 2), (D1, "é/ü=%", 2), (D2, "a b", 3)]
    with pytest.raises(checks.InputError, match="not kept"):
        table.read(1)


def test_marks_do_not_depend_on_order_and_see_every_change(spark):
    base = [("g", None, "a", 1.0), ("g", "a", None, 1.0), ("g", "a", None, 1.0), ("h", "x", "y", None)]
    kinds = "k string, a string, b string, c double"

    def of(values, partitions=1):
        df = spark.createDataFrame(values, kinds).repartition(partitions)
        return {r.k: r.mark for r in marks(df, ["k"], ["a", "b", "c"]).collect()}

    assert of(base) == of(base[::-1], 3)
    changes = [base[:2] + base[3:], base + base[1:2], [("g", "a", None, 1.0)] * 3 + base[3:], [("g", None, "a", 1.5), *base[1:]]]
    assert all(of(c)["g"] != of(base)["g"] and of(c)["h"] == of(base)["h"] for c in changes)
    df = spark.createDataFrame(base, kinds)
    assert table_mark(df, df.limit(0)) != table_mark(df) and table_mark(df) == table_mark(df.select("c", "b", "a", "k"))


def test_only_changed_slices_are_made_again(spark, star, tmp_path, monkeypatch):  # noqa: F811
    path = str(tmp_path / "rollup")
    fact, *dims = star
    fact = fact.unionByName(spark.createDataFrame([sale("s1", "p2", 3, month=D2)], FACT))
    period = ("01.01.2024", "31.03.2024", ["N"], ["N", "M"])
    table = rollup.slice_table(spark, path)
    assert rollup.refresh_changed(fact, *dims, path, *period) == [(D1, "N"), (D2, "N")]
    first = table.manifest()
    with monkeypatch.context() as patch:
        patch.setattr(rollup, "build", None)  # nothing is built
        assert rollup.refresh_changed(fact.repartition(5), *dims, path, *period) == []
    assert table.versions() == [1]
    more = fact.unionByName(spark.createDataFrame([sale("s1", "p2", 1, month=D2)], FACT))
    assert rollup.refresh_changed(more, *dims, path, *period) == [(D2, "N")]
    assert table.manifest().slices[D1, "N"] == first.slices[D1, "N"]
    assert {r.pieces for r in rollup.read_rollup(spark, path, [(D2, "N")]).collect()} == {4}
    with pytest.raises(checks.InputError, match="would keep their old ones"):
        rollup.refresh_changed(more.where(F.col("month_year") == D1), *dims, path, *period)
    assert rollup.refresh_changed(more.where(F.col("month_year") == D1), *dims, path, *period, may_be_empty=True) == [(D2, "N")]
    assert set(table.manifest().slices) == {(D1, "N")}
    skus, stores, networks = dims
    heavier = skus.withColumn("weight", F.col("weight") * 2)
    assert rollup.refresh_changed(more, heavier, stores, networks, path, *period) == [(D1, "N"), (D2, "N")]
    whole = {"subname": F.col("network_name")}
    assert rollup.refresh_changed(more, heavier, stores, networks, path, *period, **whole) == [(D1, "N"), (D2, "N")]
    plain = rollup.build(more, heavier, stores, networks, **whole)
    assert sorted(map(str, rollup.read_rollup(spark, path).drop("last_update").collect())) == sorted(map(str, plain.select(*rollup.read_rollup(spark, path).drop("last_update").columns).collect()))


def test_marks_are_combined_before_the_shuffle(spark, star):  # noqa: F811
    fact = star[0]
    plan = marks(fact, ["month_year", "network_name"], ["pieces"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Python" not in plan


def test_refresh_deletes_or_refuses_slice_by_slice(spark, star, tmp_path):  # noqa: F811
    path = str(tmp_path / "rollup")
    fact, *dims = star
    both = fact.unionByName(spark.createDataFrame([sale("s1", "p2", 3, month=D2)], FACT))
    job = (*dims, path, "01.01.2024", "31.03.2024", ["N"], ["N"])
    with pytest.raises(checks.InputError, match="no sales for N in 2024-03-01"):
        rollup.refresh(both, *job)
    rollup.refresh(both, *job, may_be_empty=[(date(2024, 3, 1), "N")])
    with pytest.raises(checks.InputError, match="no sales for N in 2024-02-01"):
        rollup.refresh(fact, *job, may_be_empty=[(date(2024, 3, 1), "N")])
    assert set(rollup.slice_table(spark, path).manifest().slices) == {(D1, "N"), (D2, "N")}
    rollup.refresh(fact, *job, may_be_empty=True)
    assert set(rollup.slice_table(spark, path).manifest().slices) == {(D1, "N")}
