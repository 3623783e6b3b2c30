"""Readers and sink on files written here."""

import datetime as dt
import gzip
from pathlib import Path

import pytest

from trendloom.operators import periods
from trendloom.plans.population import population_segment
from trendloom.schema import TREND_COLUMNS, conform
from trendloom.session import clean_stages, shared_folder, stage
from trendloom.sources import landed, readers, sink
from trendloom.workload import files


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_titles_by_header_with_byte_order_mark(spark, tmp_path, rows):
    path = write(
        tmp_path / "t.csv",
        "﻿County,Ignored,Transaction Count,Make,2020 GEOID,Transaction Type,New or Used Vehicle,Electrification Level,Transaction Month and Year",
        "King,x,3,A,53033000100,Original Title,New,BEV (Battery Electric Vehicle),1/1/2020",
    )
    assert rows(readers.read_titles(spark, path), "county", "tract", "transactions") == [("King", "53033000100", 3.0)]


def test_only_used_title_columns_are_parsed(spark, tmp_path):
    path = write(tmp_path / "t.csv", ",".join(readers.TITLE_HEADERS), ",".join("x" for _ in readers.TITLE_HEADERS))
    plan = readers.read_titles(spark, path).select("county")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<County:string>" in plan


def test_year_from_the_file_name(spark, tmp_path, rows):
    for year in ("19", "20"):
        write(tmp_path / f"cy{year}-enplanements.csv", "a,b,c,d,e,City,g,h,Boarded,Cargo", f"1,2,3,4,5,SEA,7,8,{year}00,10")
    got = readers.read_by_filename(spark, str(tmp_path), [6, 9], ["geography", "estimate"], 3, 2, "20")
    assert rows(got) == [("SEA", "1900", "2019"), ("SEA", "2000", "2020")]


def test_month_key_from_the_file_name(spark, tmp_path, rows):
    for key in ("012020", "022020"):
        write(tmp_path / f"traf-ops-{key}.csv", "Category,unused,Estimate", f"CARGO GRAND TOTAL,x,{int(key)}")
    got = readers.read_by_filename(spark, str(tmp_path), [1, 3], ["variable", "estimate"], 10, 6)
    assert rows(got) == [("CARGO GRAND TOTAL", "12020", "012020"), ("CARGO GRAND TOTAL", "22020", "022020")]


def test_transit_sheets(spark, tmp_path, rows):
    ids = "NTD.ID,Legacy.NTD.ID,Agency,Status,Reporter.Type,UACE.CD,UZA.Name,Mode,TOS,3.Mode"
    paths = {
        "UPT": write(tmp_path / "upt.csv", ids + ",1/2020", "1,,Metro,A,F,1,Seattle,MB,DO,Bus,5"),
        "VRM": write(tmp_path / "vrm.csv", ids + ",1/2020,2/2020", "1,,Metro,A,F,1,Seattle,MB,DO,Bus,6,7"),
    }
    got = readers.read_transit(spark, paths)
    assert set(got.columns) == {"agency_id", "agency", "mode", "tos", "metric", "1/2020", "2/2020"}
    assert rows(got, "metric", "`2/2020`") == [("UPT", None), ("VRM", "7")]


def test_agencies_and_lookup(spark, tmp_path, rows):
    agencies = write(tmp_path / "a.csv", "NTDID,UACE,MPO_AREA,AGENCY_NAME", "1,80389,Seattle,Metro")
    assert rows(readers.read_agencies(spark, agencies), "NTDID", "UACE") == [("00001", "80389")]
    lookup = write(tmp_path / "l.csv", "﻿variable,simple_label,label", "X_001,Total,All of it")
    assert rows(readers.read_lookup(spark, lookup, "x")) == [("x", "X_001", "Total")]


def test_population_file(spark, tmp_path, rows):
    path = write(tmp_path / "p.csv", "Line,Filter,County,Jurisdiction,2021.Population.Estimate", "1,4,King,Algona (part) ,3190")
    got = population_segment(readers.read_wide(spark, path), "latest")
    assert rows(got) == [(4.0, "Algona", "2021", 3190.0)]


def test_housing_forecast(spark, tmp_path, rows):
    path = write(tmp_path / "h.csv", "Year,Observed,Forecast", "2020,10,", "2021,,11.5")
    assert rows(readers.read_housing_forecast(spark, path)) == [(2020, 10.0, None), (2021, None, 11.5)]


def test_acs_reads_only_the_asked_folders(spark, tmp_path):
    path = str(tmp_path / "acs")
    spark.range(8).selectExpr("id AS estimate", "concat('B', id % 2) AS acs_table", "2020 + id % 4 AS year").write.partitionBy("acs_table", "year").parquet(path)
    got = readers.read_acs(spark, path, ["B0"], [2022])
    assert got.count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "acs_table" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_sink_round_trip_is_partitioned_by_metric(spark, tmp_path, rows):
    path = str(tmp_path / "trends")
    df = conform(spark.createDataFrame([("2020", "a", 1.0), ("2021", "b", 2.0)], "year string, metric string, estimate double"))
    sink.write_trends(df, path)
    assert sorted(p.name for p in (tmp_path / "trends").glob("metric=*")) == ["metric=a", "metric=b"]
    back = sink.read_trends(spark, path)
    assert back.columns == TREND_COLUMNS
    assert rows(back) == rows(df)


def test_catalog_table(spark):
    spark.range(3).createOrReplaceTempView("facts")
    assert readers.read_table(spark, "facts").count() == 3


def test_shared_folder_is_the_sessions(spark, rows):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5))
    assert staged.count() == 5
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()
    folder = Path(staged.inputFiles()[0].removeprefix("file:")).parent
    clean_stages(spark)
    assert not folder.exists()


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_sink_keeps_other_metrics(spark, tmp_path, rows):
    path = str(tmp_path / "trends")
    for metric in ("a", "b", "a"):
        sink.write_trends(conform(spark.createDataFrame([("2020", metric, 1.0)], "year string, metric string, estimate double")), path)
    assert rows(sink.read_trends(spark, path), "metric") == [("a",), ("b",)]
    sink.write_trends(conform(spark.createDataFrame([("2020", "c", 1.0)], "year string, metric string, estimate double")), path, whole=True)
    assert rows(sink.read_trends(spark, path), "metric") == [("c",)]


def test_doubled_quotes_and_headers_in_another_order(spark, tmp_path, rows):
    one = write(tmp_path / "t" / "1.csv", "a,b", '"Metro ""King"", Ferry",2')
    assert readers.read_wide(spark, one).first()[0] == 'Metro "King", Ferry'
    write(tmp_path / "t" / "2.csv", "b,a", "3,x")
    assert rows(readers.read_wide(spark, str(tmp_path / "t")), "a", "b") == [('Metro "King", Ferry', "2"), ("x", "3")]


def test_header_below_a_preamble_that_differs_by_file(spark, tmp_path, rows):
    write(tmp_path / "a b" / "x 1.csv", "\ufeffTitle, of it", "", ",,", "a,b,c", '1,"x ""q"" y",3', "", "4,5", "6,7,8,9", '"p,q",,')
    write(tmp_path / "a b" / "x 2.csv", "c,a", "7,8")
    (tmp_path / "a b" / "empty.csv").write_text("")
    path = str(tmp_path / "a b")
    assert rows(landed.read_landed(spark, path, ["a", "c"]), "a", "b", "c") == sorted(
        [("1", 'x "q" y', "3"), ("4", "5", None), ("6", "7", "8"), ("p,q", None, None), ("8", None, "7")], key=lambda r: [(v is not None, v or "") for v in r]
    )
    with pytest.raises(ValueError, match="no header line"):
        landed.read_landed(spark, path, ["a", "nowhere"])
    found = landed.set_aside(spark, path, {"a": "A", "c": "C"}, ["C"], ["a", "c"])
    assert rows(found.rows) == [("1", 3.0), ("8", 7.0), ("p,q", None)]
    assert rows(found.malformed, "line", "reason") == [("4,5", "number of cells"), ("6,7,8,9", "number of cells")]
    with pytest.raises(ValueError, match="lacks"):
        landed.set_aside(spark, path, {"b": "B"}, header=["a", "c"])


def test_blank_and_repeated_header_names(spark, tmp_path, rows):
    path = write(tmp_path / "t.csv", "a,,A,b", "1,2,3,4")
    got = landed.read_landed(spark, path)
    assert got.columns == ["a", "_c1", "A_c2", "b"] and rows(got) == [("1", "2", "3", "4")]


def test_compressed_file_below_a_title(spark, tmp_path, rows):
    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write("Title\na,b\n1,2\n")
    assert rows(readers.read_wide(spark, str(tmp_path / "t.csv.gz"), 2)) == [("1", "2")]


def test_malformed_lines_are_kept_in_quarantine(spark, tmp_path, rows):
    header = ",".join(readers.TITLE_HEADERS)
    path = write(tmp_path / "t.csv", header, "1/1/2020,New,Original Title,BEV,A,King,1,2", "1/1/2020,New", "1/1/2020,New,Original Title,BEV,A,King,1,many", "1/1/2020,New,Original Title,BEV,A,King,1,")
    found = readers.titles_set_aside(spark, path)
    assert rows(found.rows, "transactions") == [(None,), (2.0,)]
    for _ in range(2):
        landed.write_quarantine(found, str(tmp_path / "q"))
    kept = spark.read.parquet(str(tmp_path / "q"))
    assert rows(kept.groupBy("reason").count()) == [("no number: transactions", 2), ("number of cells", 2)]


def test_malformed_json(spark, tmp_path, rows):
    path = write(tmp_path / "t.json", '{"date": "2022-01-31", "county": "King", "total_vehicles": "7"}', '{"county": "Ki', "nothing")
    found = readers.registrations_set_aside(spark, path)
    assert rows(found.rows, "county", "total_vehicles") == [("King", "7")]
    assert rows(found.malformed, "line") == [("nothing",), ('{"county": "Ki',)]


def test_forty_sheets_are_one_scan(spark, tmp_path):
    paths = {f"s{i}": write(tmp_path / f"{i}.csv", f"id,m{i % 3}", f"{i},x") for i in range(40)}
    got = readers.read_sheets(spark, paths)
    assert got.groupBy("sheet").count().count() == 40 and got.columns == ["id", "m0", "m1", "m2", "sheet"]
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_missing_months_come_from_the_listing(spark, tmp_path, rows):
    for key in ("012020", "032020"):
        write(tmp_path / "m" / f"traf-ops-{key}.csv", "x")
    months = periods.expected_months(spark, dt.date(2020, 1, 1), dt.date(2020, 4, 1))
    got = landed.missing_month_files(spark, str(tmp_path / "m"), months, 10, 6)
    assert rows(got, "month_key") == [("022020",), ("042020",)]
    listed = landed.landed_files(spark, str(tmp_path / "m"))
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert rows(listed, "name", "length") == [("traf-ops-012020.csv", 2), ("traf-ops-032020.csv", 2)]


def test_a_key_with_many_lines_is_landed_as_several_files(spark, rows, monkeypatch):
    """Most lines are equal and of one key; every file has its own preamble and header."""
    monkeypatch.setattr(files, "FILE_LINES", 100, raising=False)
    df = spark.range(1000).selectExpr("if(id < 40, 'b', if(id = 50, null, 'a')) AS key", "if(id < 900, 7, id) AS n")
    path = Path(files._land(spark, files._lines(df, df.key, ["Title"]), "x-{}.csv"))
    found = {p.name: p.read_text().splitlines() for p in path.glob("*.csv")}
    assert all(lines[:2] == ["Title", "key,n"] and len(lines) < 180 for lines in found.values())
    assert len(found) == 12 and {name[2] for name in found} == {"a", "b", "_"}
    assert rows(readers.read_wide(spark, str(path), 2).selectExpr("key", "cast(n AS long)")) == rows(df)
