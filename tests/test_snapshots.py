"""Versioned tables: atomic replacement, gates, expiry; the ledger refreshed from a cut."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stockgap.operators.ledger import stock_ledger
from stockgap.operators.refresh import refresh_ledger
from stockgap.sources.files import Files
from stockgap.sources.snapshots import ConflictError, ConstraintError, SnapshotTable


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k int, v string, month int")


def content(table, version=None):
    return sorted(tuple(r) for r in table.read(version).collect())


def test_versions_partitions_and_expiry(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.versions() == [] and t.expire() == []
    assert t.write(rows(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), "month") == 1
    assert t.write(rows(spark, (4, "d", 2), (5, "e", 4)), "month", keep=lambda m: int(m) < 3) == 2
    assert content(t) == [(1, "a", 1), (4, "d", 2), (5, "e", 4)]
    assert content(t, 1) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    early = t.read(1)
    assert t.write(rows(spark, (6, "f", 2)), "month", keep=lambda m: True) == 3
    assert sorted(early.collect())[1].v == "b"          # a reader keeps the version it resolved
    assert t.expire(keep=1) == [1, 2] and t.versions() == [3]
    assert content(t) == [(1, "a", 1), (5, "e", 4), (6, "f", 2)]
    held = Files(spark, f"{tmp_path}/t/data")
    assert [len(held.names(f)) for f in held.names()] == [1, 1, 1]  # of each version only the month that is still named
    with pytest.raises(FileNotFoundError):
        t.read(1)


def test_without_partitions_and_empty(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    t.write(rows(spark, (1, "a", 1)), info={"note": 7}, checks={"v": F.col("v").isNotNull()}, keys=["k"])
    assert t.info() == {"note": 7} and content(t) == [(1, "a", 1)]
    t.write(rows(spark).where("k > 0"), checks={"v": F.col("v").isNotNull()}, keys=["k"])
    assert content(t) == [] and t.versions() == [1, 2]
    t.write(rows(spark), "month")
    assert content(t) == [] and t.read().columns == ["k", "v", "month"]


def test_a_write_that_dies_leaves_the_earlier_version(spark, tmp_path, monkeypatch):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    t.write(rows(spark, (1, "a", 1)), "month")
    dies = spark.range(0, 40, 1, 8).select(
        F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("int")).alias("k"),
        F.lit("x").alias("v"), (F.col("id") % 4).cast("int").alias("month"))
    with pytest.raises(Exception, match="lost"):           # between files
        t.write(dies, "month")
    assert content(t) == [(1, "a", 1)] and len(t.files.names("data")) == 1
    with monkeypatch.context() as m:                       # all files there, no manifest
        m.setattr(SnapshotTable, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            t.write(rows(spark, (2, "b", 1)), "month")
    assert content(t) == [(1, "a", 1)] and len(t.files.names("data")) == 2
    t.files.write_new("manifests/000000000003.json", json.dumps(t.manifest())[:50])  # a manifest cut short
    assert content(t) == [(1, "a", 1)] and t.versions() == [1]
    assert t.write(rows(spark, (3, "c", 1)), "month") == 4 and content(t) == [(3, "c", 1)]
    t.expire(keep=1)                                       # what the dead writes left goes as well
    assert t.files.names("manifests") == ["000000000004.json"] and len(t.files.names("data")) == 1


def test_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    t, other = SnapshotTable(spark, f"{tmp_path}/t"), SnapshotTable(spark, f"{tmp_path}/t")
    t.write(rows(spark, (1, "a", 1)))
    plain = SnapshotTable._write_files

    def meanwhile(self, *a):
        monkeypatch.setattr(SnapshotTable, "_write_files", plain)
        other.write(rows(spark, (2, "b", 1)))
        return plain(self, *a)
    monkeypatch.setattr(SnapshotTable, "_write_files", meanwhile)
    with pytest.raises(ConflictError):
        t.write(rows(spark, (3, "c", 1)))
    assert content(t) == [(2, "b", 1)]


def test_gate(spark, tmp_path):
    t, parent = SnapshotTable(spark, f"{tmp_path}/t"), spark.createDataFrame([("a",), ("b",)], "name string")
    rules = dict(checks={"k is positive": F.col("k") > 0, "v not null": F.col("v").isNotNull()}, keys=["k"],
                 references={"v -> names": ("v", parent, "name")})
    t.write(rows(spark, (1, "a", 1), (2, "b", 1)), **rules)
    for bad, said in [([(0, "a", 1), (-1, None, 1), (None, "a", 1)], {"k is positive": 2, "v not null": 1}),
                      ([(1, "a", 1), (1, "b", 2)], {"unique (k)": 2}), ([(1, "x", 1), (2, "x", 1), (3, "a", 1)], {"v -> names": 2})]:
        with pytest.raises(ConstraintError) as e:
            t.write(rows(spark, *bad), **rules)
        assert e.value.broken == said and all(name in str(e.value) for name in said)
        assert content(t) == [(1, "a", 1), (2, "b", 1)] and len(t.files.names("data")) == 1


def ledger_of(wh):
    return sorted(tuple(r) for r in stock_ledger(wh).collect())


def stored(table):
    return sorted(tuple(r) for r in table.read().drop("month").collect())


def folders(table):
    return {n: f.split("/")[0] for n, f in table.manifest()["folders"].items()}


def test_refresh_recomputes_only_from_the_cut(spark, tmp_path, planted):
    until = lambda wh, day: replace(wh, calendar=wh.calendar.where(F.col("full_date") <= day), movements=wh.movements.where(F.col("full_date") <= day))
    t = SnapshotTable(spark, f"{tmp_path}/ledger")
    early = until(planted, "2023-04-20")
    assert refresh_ledger(early, t) == 1 and stored(t) == ledger_of(early)
    assert refresh_ledger(early, t) is None                        # nothing changed, nothing written
    assert refresh_ledger(planted, t) == 2 and stored(t) == ledger_of(planted)
    kept, all_of = folders(t), folders
    assert {m for m, f in kept.items() if f.startswith("version=1-")} == {"month=202301", "month=202302", "month=202303"}
    # a late line in February, although only June is asked for, moves the cut to February
    late = spark.createDataFrame([(dt.date(2023, 2, 14), *planted.movements.select("distributor_id", "sku_id").first(), None, 77)], planted.movements.schema)
    later = replace(planted, movements=planted.movements.unionByName(late))
    assert refresh_ledger(later, t, since=dt.date(2023, 6, 3)) == 3 and stored(t) == ledger_of(later)
    assert {m for m, f in all_of(t).items() if f.startswith("version=1-")} == {"month=202301"}
    assert refresh_ledger(later, t, since=dt.date(2023, 6, 3)) == 4 and stored(t) == ledger_of(later)
    assert {m for m, f in all_of(t).items() if f.startswith("version=4-")} == {"month=202306"}
    # back to a shorter calendar; and a new distributor changes every month
    assert refresh_ledger(early, t) == 5 and stored(t) == ledger_of(early)
    fewer = replace(early, products=early.products.limit(1), movements=early.movements.join(early.products.limit(1).select("sku_id"), "sku_id", "left_semi"))
    assert refresh_ledger(fewer, t) == 6 and stored(t) == ledger_of(fewer) and set(f[:9] for f in all_of(t).values()) == {"version=6"}


def test_refresh_reads_only_the_month_before_the_cut(spark, tmp_path, planted, monkeypatch):
    t = SnapshotTable(spark, f"{tmp_path}/ledger")
    refresh_ledger(planted, t)
    plans, plain = [], SnapshotTable.write
    monkeypatch.setattr(SnapshotTable, "write", lambda self, df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(self, df, *a, **k))
    refresh_ledger(planted, t, since=dt.date(2023, 5, 9))
    assert "PartitionFilters: [isnotnull(month" in plans[0] and "(month#" in plans[0] and "= 202304)" in plans[0]


def test_load_command_gates_each_table(spark, tmp_path, capsys):
    from fixtures import write_planted_csvs

    from stockgap import __main__ as cli
    folder, out = tmp_path / "csv", str(tmp_path / "all")
    folder.mkdir()
    write_planted_csvs(str(folder))
    cli.main(["--csv", str(folder), "load", "--out", out])
    assert "ledger: version 1" in capsys.readouterr().out
    cli.main(["--csv", str(folder), "load", "--out", out, "--keep", "1"])
    assert "ledger: unchanged" in capsys.readouterr().out
    sold, ledger = SnapshotTable(spark, f"{out}/fact_secondary_sales"), SnapshotTable(spark, f"{out}/ledger")
    n = sold.read().count()
    assert sold.versions() == [2] and ledger.read().count() == 181 * 6 * 2
    name = folder / "fact_secondary_sales.csv"
    good = name.read_text()
    header, first, *rest = good.splitlines()
    cells = first.split(",")
    for cell, value, said in [(5, "-3", "qty_units >= 0"), (3, "D99", "distributor_id -> dim_distributor"), (5, "", "qty_units not null"),
                              (0, rest[0].split(",")[0], r"unique \(secondary_order_id\)")]:
        bad = [*cells]
        bad[cell] = value
        name.write_text("\r\n".join([header, ",".join(bad), *rest]) + "\r\n")
        with pytest.raises(ConstraintError, match=said):
            cli.main(["--csv", str(folder), "load", "--out", out])
        assert sold.versions() == [2] and sold.read().count() == n and ledger.versions() == [1]


def test_violating_rows(spark):
    from stockgap.operators.quality import tagged_rows
    df = spark.createDataFrame([(1, 1, 5, "a"), (1, 1, -5, "zz"), (1, 2, None, None), (None, 3, 1, "a"), (None, 3, 1, "a"), (2, 1, 7, "a")],
                               "o int, n int, q int, p string")
    parent = spark.createDataFrame([("a",), (None,), ("a",)], "p string").withColumnRenamed("p", "name")
    got = tagged_rows(df, "t", ["o", "n"], [("o not null", F.col("o").isNotNull()), ("q >= 0", F.col("q") >= 0)], [("p -> names", "p", parent, "name")])
    assert sorted(tuple(r) for r in got.collect()) == [
        ("t", "1|1", 2, "q >= 0,p -> names,unique(o, n)"), ("t", "NULL|3", 2, "o not null,unique(o, n)")]
    assert tagged_rows(df.limit(0), "t", ["o"], []).count() == 0
    with pytest.raises(ValueError, match="63"):
        tagged_rows(df, "t", ["o"], [(str(i), F.lit(True)) for i in range(63)])
