"""CSV loads by position (header clash, CR LF, booleans, blank file), export."""

import os

from pyspark.sql import functions as F

from stockgap import schemas as S
from stockgap.operators.ledger import stock_ledger
from stockgap.sources.csv_io import export_csv, load_csv, write_table


def test_positional_load_with_header_clash(spark, tmp_path):
    p = tmp_path / "dim_date.csv"
    p.write_bytes(b"date,date_id,year,month,day,is_month_end\r\n"
                  b"2023-01-31,20230131,2023,1,31,True\r\n2023-02-01,20230201,2023,2,1,False\r\n")
    rows = load_csv(spark, str(p), S.DIM_DATE).collect()
    assert [(str(r.full_date), r.date_id, r.is_month_end) for r in rows] == [
        ("2023-01-31", 20230131, True), ("2023-02-01", 20230201, False)]


def test_blank_file_is_empty(spark, tmp_path):
    p = tmp_path / "fact_secondary_sales.csv"
    p.write_bytes(b"\r\n")
    assert load_csv(spark, str(p), S.FACT_SECONDARY).count() == 0


def test_export_round_trip_and_overwrite(spark, tmp_path, planted):
    out = str(tmp_path / "risk")
    df = planted.distributors
    export_csv(df, out, single_file=True)
    export_csv(df, out, single_file=True)           # idempotent rebuild
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    back = load_csv(spark, out, S.DIM_DISTRIBUTOR)
    assert sorted(back.collect()) == sorted(df.collect())


def test_write_table_dynamic_overwrite(spark, tmp_path, planted):
    led = stock_ledger(planted).withColumn("month", F.col("date_id").cast("string").substr(1, 6))
    path = str(tmp_path / "ledger")
    write_table(led, path, ("month",))
    january = led.filter(F.col("date_id") < 20230201)
    write_table(january, path, ("month",), only_present=True)        # a rebuild of one month
    assert spark.read.parquet(path).count() == 181 * 6 * 2
    write_table(january, path, ("month",))                           # a rebuild of all
    assert spark.read.parquet(path).count() == 31 * 6 * 2


def test_month_rebuild_leaves_nothing_stale(spark, tmp_path, planted):
    from dataclasses import replace

    from stockgap.operators.ledger import materialize_ledger
    path = str(tmp_path / "ledger")
    materialize_ledger(planted, path, layout="month", files_per_month=2)
    months = [f for f in os.listdir(path) if f.startswith("month=")]
    assert all(len([x for x in os.listdir(f"{path}/{m}") if x.endswith(".parquet")]) <= 2 for m in months)
    short = replace(planted, calendar=planted.calendar.filter(F.col("date_id") < 20230501))
    materialize_ledger(short, path, layout="month")
    back = spark.read.parquet(path)
    assert back.agg(F.max("date_id")).first()[0] == 20230430 and back.count() == 120 * 6 * 2


def test_csv_folder_by_uri_and_missing_tables(spark, tmp_path):
    import pytest
    from fixtures import write_planted_csvs

    from stockgap.operators.leakage import promo_calendar
    from stockgap.params import REFERENCE
    from stockgap.sources.reference import bind_reference_tables, load_reference_csvs
    folder = tmp_path / "csv"
    folder.mkdir()
    write_planted_csvs(str(folder))
    tables = load_reference_csvs(spark, f"file://{folder}")
    assert set(tables) == set(load_reference_csvs(spark, str(folder))) and len(tables) >= 6
    # the promotion seed stands in for a table that the folder does not have
    seeded = bind_reference_tables({k: v for k, v in tables.items() if k != "dim_promotion"})
    assert [r.promotion_id for r in promo_calendar(seeded, REFERENCE.leakage).collect()] == ["PROMO001"]
    os.rename(folder / "dim_distributor.csv", folder / "other.csv")
    with pytest.raises(FileNotFoundError, match="dim_distributor"):
        load_reference_csvs(spark, f"file://{folder}")


def test_materialize_ledger_layouts(spark, tmp_path, planted):
    from stockgap.operators.ledger import materialize_ledger
    for layout in ("generated", "month"):
        path = str(tmp_path / f"ledger-{layout}")
        materialize_ledger(planted, path, layout=layout)
        materialize_ledger(planted, path, layout=layout)      # rebuild replaces
        back = spark.read.parquet(path)
        assert back.count() == 181 * 6 * 2
    months = {r.month for r in spark.read.parquet(str(tmp_path / "ledger-month"))
              .select("month").distinct().collect()}
    assert months == {202301, 202302, 202303, 202304, 202305, 202306}


def test_dashboard_extracts(spark, tmp_path, planted):
    from stockgap.operators.reports import export_dashboard_extracts
    from stockgap.params import REFERENCE
    paths = export_dashboard_extracts(spark, planted, str(tmp_path / "csv"), REFERENCE)
    risk = spark.read.option("header", True).csv(paths["risk_list"])
    assert risk.count() == 6
    series = spark.read.option("header", True).csv(paths["distributor_series"])
    assert series.count() == 181
    assert len([f for f in os.listdir(paths["pair_series"]) if f.endswith(".csv")]) == 1


def test_checked_load_quarantines_with_file_line_and_reason(spark, tmp_path):
    import pytest

    from stockgap.sources.csv_io import RejectedError, load_csv_checked
    a, b = tmp_path / "in" / "a.csv", tmp_path / "in" / "b.csv"
    a.parent.mkdir()
    good = ["D%d,\"Name, %d\",R1,Urban" % (i, i) for i in range(3000)]
    a.write_bytes(("distributor_id,distributor_name,rep_id,region\r\n" + "\r\n".join([*good[:2000], "", "D9,only two", *good[2000:], "X,,R1,Urban", "a,b,c,d,e"]) + "\r\n").encode())
    b.write_bytes(b"distributor_id,distributor_name,rep_id,region\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # many splits a file
    try:
        got = load_csv_checked(spark, str(a.parent), S.DIM_DISTRIBUTOR)
        assert got.rows.count() == 3000 and got.rows.where("distributor_name = 'Name, 7'").count() == 1
        assert sorted((r.file.rsplit("/", 1)[1], r.line, r.reason, r.text) for r in got.rejects.collect()) == [
            ("a.csv", 2003, "not 4 values", "D9,only two"), ("a.csv", 3004, "distributor_name is missing", "X,,R1,Urban"), ("a.csv", 3005, "not 4 values", "a,b,c,d,e")]
        assert load_csv_checked(spark, str(a.parent), S.DIM_DISTRIBUTOR, limit=3).rows.count() == 3000
        with pytest.raises(RejectedError, match="3 lines rejected, at most 2") as e:
            load_csv_checked(spark, str(a.parent), S.DIM_DISTRIBUTOR, limit=2)
        assert e.value.rejects.count() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    p = tmp_path / "dim_promotion.csv"
    p.write_text("promotion_id,promo_name,sku_id,promo_start,promo_end,discount_pct\nP1,x,S1,2023-01-01,2023-02-30,5\nP2,x,S1,2023-01-01,2023-02-03,5.5\nP3,x,S1,2023-01-01, 2023-02-03 ,7\n")
    got = load_csv_checked(spark, str(p), S.DIM_PROMOTION)
    assert [(r.line, r.reason) for r in got.rejects.orderBy("line").collect()] == [(2, "promo_end is no date"), (3, "discount_pct is no int")]
    assert [(r.promotion_id, str(r.promo_end), r.discount_pct) for r in got.rows.collect()] == [("P3", "2023-02-03", 7)]
    blank = tmp_path / "blank.csv"
    blank.write_bytes(b"\r\n")
    assert load_csv_checked(spark, str(blank), S.FACT_SECONDARY).rows.count() == 0
    days = tmp_path / "dim_date.csv"
    days.write_bytes(b"date,date_id,year,month,day,is_month_end\r\n2023-01-31,20230131,2023,1,31,True\r\n2023-02-01,20230201,2023,2,1,False\r\n")
    assert sorted(load_csv_checked(spark, str(days), S.DIM_DATE).rows.collect()) == sorted(load_csv(spark, str(days), S.DIM_DATE).collect())


def test_one_named_file_in_order(spark, tmp_path, planted):
    from stockgap.operators.reports import export_dashboard_extracts
    from stockgap.params import REFERENCE
    from stockgap.sources.csv_io import export_csv_file
    df = spark.range(0, 5000, 1, 7).selectExpr("5000 - id AS n", "concat('a, \"b\" ', id) AS `odd name`").orderBy("n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert df.rdd.getNumPartitions() > 1
        for _ in range(2):  # in place of the earlier one
            export_csv_file(df, f"{tmp_path}/out/list.csv")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [f for f in os.listdir(tmp_path / "out") if not f.startswith(".")] == ["list.csv"]
    lines = (tmp_path / "out" / "list.csv").read_text().splitlines()
    assert lines[0] == 'n,"odd name"' and [int(x.split(",")[0]) for x in lines[1:]] == list(range(1, 5001))
    import csv
    assert list(csv.reader(lines[1:2])) == [["1", 'a, "b" 4999']]
    export_csv_file(df.where("n < 0"), f"{tmp_path}/out/none.csv")
    assert (tmp_path / "out" / "none.csv").read_text() == 'n,"odd name"\n'
    paths = export_dashboard_extracts(spark, planted, str(tmp_path / "csv"), REFERENCE, files=True)
    assert paths["risk_list"].endswith("/risk_list.csv") and os.path.isfile(paths["risk_list"])
    ranked = (tmp_path / "csv" / "risk_list.csv").read_text().splitlines()
    assert len(ranked) == 7 and ranked[0].startswith("distributor_id,") and ranked[1].startswith("D02,")
