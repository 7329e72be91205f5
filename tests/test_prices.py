import datetime

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import returns as R
from tidegrid.sources import prices as P

BAR = "symbol string, date date, open double, high double, low double, close double, adj_close double, volume long"


def day(n):
    return datetime.date(2021, 1, n)


def bar(symbol, n, o, c, adj=None, flat=False):
    return (symbol, day(n), o, max(o, c) + (not flat), min(o, c), c, adj if adj is not None else c, 1)


def test_returns_golden(spark):
    bars = spark.createDataFrame([bar("A", 1, 10.0, 11.0), bar("A", 2, 12.0, 12.6)], BAR)
    first, second = R.overnight_intraday_returns(bars).orderBy("date").collect()
    assert first.intraday == pytest.approx(0.10) and second.intraday == pytest.approx(0.05)
    assert first.overnight is None and first.close_to_close is None
    assert second.close_to_close == pytest.approx(0.1454545454)
    assert second.overnight == pytest.approx(0.0909090909)
    (only,) = R.cumulative_returns(bars).collect()
    assert only.date == day(2)
    assert only.cum_intraday == pytest.approx(1.1 * 1.05 - 1)
    assert only.cum_overnight == pytest.approx(0.0909090909)


def test_split_series_gives_the_same_returns(spark):
    rows = [
        (f"S{s}", datetime.date(2000, 1, 1) + datetime.timedelta(d), 10 + (d * s) % 7, 0.0, 0.0, 11.0 + d % 5, 9.0 + d % 3, 1)
        for s in range(3)
        for d in range(400 if s else 1200)
    ]
    bars = spark.createDataFrame([tuple(float(x) if isinstance(x, int) and i < 7 else x for i, x in enumerate(r)) for r in rows], BAR)

    def rounded(frame):
        return sorted((r[0], r[1], f"{r[2]:.9e}", f"{r[3]:.9e}") for r in frame.collect())

    assert rounded(R.cumulative_returns(bars)) == rounded(R.cumulative_returns(bars, segment_rows=50))


def test_zero_price_and_single_bar(spark):
    bars = spark.createDataFrame([bar("A", 1, 0.0, 1.0), bar("A", 2, 1.0, 2.0), bar("B", 1, 1.0, 2.0)], BAR)
    rows = {(r.symbol, r.date.day): r for r in R.overnight_intraday_returns(bars).collect()}
    assert rows["A", 1].intraday is None and rows["A", 2].intraday == 1
    assert [r.symbol for r in R.cumulative_returns(bars).collect()] == ["A"]


def test_cleaning(spark):
    bars = spark.createDataFrame(
        [
            bar("A", 2, 5.0, 5.0),
            bar("A", 3, 5.0, 6.0),
            bar("A", 4, 5.0, 5.0, flat=True),
            bar("A", 5, 5.0, 6.0),
            bar("A", 6, 5.0, 6.0),
            ("A", day(7), 1.0, None, 1.0, 2.0, 2.0, 1),
            bar("A", 8, 5.0, 5.0),
            bar("A", 9, 5.0, 6.0),
            bar("B", 1, 1.0, 2.0),
            bar("B", 9, 1.0, 2.0),
            bar("C", 3, 1.0, 1.0),
        ],
        BAR,
    )
    instruments = spark.createDataFrame(
        [("A", "Alpha", None, None, [day(5)]), ("B", "Beta", day(2), day(5), None)],
        "symbol string, name string, start_date date, end_date date, bad_data_dates array<date>",
    )
    kept = R.clean_bars(bars, instruments, day(1), day(8))
    assert sorted((r.symbol, r.date.day) for r in kept.collect()) == [("A", 3), ("A", 6), ("A", 8)]
    assert {r.name for r in kept.collect()} == {"Alpha"}


def test_flat_rows_count_distinct_prices(spark):
    bars = spark.createDataFrame([bar("A", 1, 1.0, 1.0, flat=True), bar("A", 2, 1.0, 2.0)], BAR)
    assert [r.n for r in bars.orderBy("date").select(R.distinct_prices().alias("n")).collect()] == [1, 3]
    assert R.drop_flat_rows(bars).count() == 1


def test_labels(values):
    given = [-99.884, 0.24, 0.25, 0.35, 2.5, 3333.4, 333333.4, -0.999, -1.0, 1.0, -99.0, 20000.0, None]
    want = ["-99.88%", "+0.2%", "+0.2%", "+0.3%", "+2%", "+3333%", "+333,333%", "-1.0%", "-1%", "+1%", "-99%", "+20,000%", None]
    assert values(R.format_return, *given, kind="double") == want


def test_final_returns(spark):
    cumulative = spark.createDataFrame(
        [("A", day(1), 0.1, 0.2), ("A", day(3), 0.5, -0.999), ("A", day(2), 9.0, 9.0)],
        "symbol string, date date, cum_intraday double, cum_overnight double",
    )
    (row,) = R.final_returns(cumulative).collect()
    assert (row.last_date, row.intraday, row.overnight) == (day(3), 0.5, -0.999)
    assert (row.intraday_label, row.overnight_label) == ("+50%", "-99.90%")


def test_price_files_round_trip(spark, tmp_path):
    bars = spark.createDataFrame([bar("A", 1, 1.5, 2.5), bar("^X", 2, 3.0, 4.0), ("A", day(2), None, 1.0, 1.0, 1.0, 1.0, 5)], BAR)
    P.write_prices(bars, str(tmp_path / "p"))
    back = P.read_prices(spark, str(tmp_path / "p"), partitioned=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, bars.collect()))


def test_price_file_names_and_headers(spark, tmp_path):
    header = "Date,Open,High,Low,Close,Adj Close,Volume"
    (tmp_path / "SPY.csv").write_text(f"{header}\n2021-01-04,1,2,0.5,1.5,1.4,100\n2021-01-05,null,null,null,null,null,null\n")
    (tmp_path / "^GSPC.csv").write_text(f"{header}\r\n2021-01-04,1,2,0.5,1.5,1.4,100\r\n\r\n")
    (tmp_path / "BAD.csv").write_text("Date,Open,Close\n2021-01-04,1,2\n")
    rows = P.read_prices(spark, str(tmp_path))
    assert sorted((r.symbol, r.open, r.volume) for r in rows.where("open is not null").collect()) == [("SPY", 1.0, 100), ("^GSPC", 1.0, 100)]
    assert rows.count() == 3 and R.drop_null_rows(rows).count() == 2
    (rejected,) = P.rejected_price_files(spark, str(tmp_path)).collect()
    assert rejected.file.endswith("BAD.csv")


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
@pytest.mark.parametrize("per_symbol", [False, True])
def test_series_files(spark, tmp_path, file_format, per_symbol):
    rows = spark.createDataFrame([("A", day(1), 0.5, -0.25), ("B", day(2), 1.0, 2.0)], "symbol string, date date, cum_intraday double, cum_overnight double")
    path = str(tmp_path / "s")
    P.write_series(rows, path, file_format, per_symbol)
    if file_format == "csv" and per_symbol:
        schema = "date date, cum_intraday double, cum_overnight double, symbol string"
        back = spark.read.schema(schema).option("header", True).csv(path).select(*rows.columns)
    else:
        back = P.read_series(spark, path, file_format).select(*rows.columns)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_patch_replaces_all_rows_of_a_key(spark):
    from tidegrid.operators.tables import patch_source

    base = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "symbol string, v int")
    patch = spark.createDataFrame([("A", 9), ("C", 7)], "symbol string, v int")
    assert sorted(patch_source(base, patch, "symbol").collect()) == [("A", 9), ("B", 3), ("C", 7)]


def test_nulls_in_any_field_drop_a_bar(spark):
    bars = spark.createDataFrame([bar("A", 1, 1.0, 2.0)], BAR)
    for column in ["open", "high", "low", "close", "adj_close", "volume"]:
        assert R.drop_null_rows(bars.withColumn(column, F.lit(None).cast("double"))).count() == 0


def test_only_the_first_line_is_a_header(spark, tmp_path):
    header = "Date,Open,High,Low,Close,Adj Close,Volume"
    good = "2021-01-04,1,2,1,2,2,5"
    files = {
        "A.csv": f"{header}\r\n{good}\r\n2021-01-05,1,2,1,oops,2,5\r\n2021-01-06,1,2\r\n2021-01-07,null,2,1,2,2,5\r\n",
        "B.csv": f"junk\n{header}\n{good}\n",
        "C.csv": "",
        "D.csv": f"{header}\n",
        "E.csv": f"{header}\n{good}\n{header}\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, newline="")
    read = sorted((r.symbol, str(r.date), r.open) for r in P.read_prices(spark, str(tmp_path)).collect())
    assert read == [("A", "2021-01-04", 1.0), ("A", "2021-01-07", None), ("E", "2021-01-04", 1.0)]
    held = sorted((r.symbol, r.line_no) for r in P.price_quarantine(spark, str(tmp_path)).collect())
    assert held == [("A", 3), ("A", 4), ("E", 3)]
    assert sorted(r.symbol for r in P.rejected_price_files(spark, str(tmp_path)).collect()) == ["B"]


def test_missing_return_stays_missing(spark):
    bars = [bar("A", n, 10.0, 10.0 + n) for n in range(1, 7)]
    bars[3] = (*bars[3][:6], None, 1)
    found = R.cumulative_returns(spark.createDataFrame(bars, BAR)).orderBy("date").collect()
    assert [r.cum_overnight is None for r in found] == [False, False, True, True, True]
    assert not any(r.cum_intraday is None for r in found)


NAMES = ["A", "^X", "a/b=c", "50%", "%41", "1+1 %2B", "B [1]", "é", "..", "", None]


def test_price_files_are_those_of_sparks_writer(spark, tmp_path):
    bars = spark.createDataFrame(
        [(n, day(d), 1.5, 1e-7, None, float("nan"), 12345678.9, d) for n in NAMES for d in (1, 2)] + [("A", None, *[None] * 6)], BAR
    )
    P.write_prices(bars, str(tmp_path / "tasks"))
    named = bars.select("symbol", *[F.col(c).alias(h) for c, h in zip(P.COLUMNS, P.HEADER)])
    ordered = named.repartitionByRange("symbol", "Date").sortWithinPartitions("symbol", "Date")
    ordered.write.partitionBy("symbol").option("header", True).option("nullValue", "null").csv(str(tmp_path / "spark"))

    def files(kind):
        folders = [f for f in (tmp_path / kind).iterdir() if f.is_dir()]
        return sorted((f.name, sorted(p.read_text() for p in f.iterdir() if p.name[0] != ".")) for f in folders)

    assert files("tasks") == files("spark")
    # Spark's writer makes a checksum file for each, and starts a process for either.
    assert not list((tmp_path / "tasks").rglob("*.crc"))
    read = P.read_prices(spark, f"file://{tmp_path}/tasks", partitioned=True)
    assert sorted(map(str, read.collect())) == sorted(map(str, bars.replace("", None, "symbol").collect()))


def test_lines_of_a_symbol_in_several_tasks_and_batches(spark, tmp_path):
    lines = spark.range(0, 60_000, 1, 3).selectExpr("'S' || (id div 25000) symbol", "CASE WHEN id <> 7 THEN 'x' || id END value")
    P.write_lines(lines, str(tmp_path / "p"))
    read = spark.read.text(str(tmp_path / "p"))
    assert sorted((r.symbol, r.value) for r in read.collect()) == sorted((r.symbol, r.value or "") for r in lines.collect())
    assert sorted(p.name for p in (tmp_path / "p").iterdir()) == ["_SUCCESS", "symbol=S0", "symbol=S1", "symbol=S2"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        P.write_lines(lines, str(tmp_path / "p"))


def test_a_failed_write_leaves_no_price_files(spark, tmp_path):
    lines = spark.range(0, 4, 1, 2).selectExpr("'S' || id symbol", "CAST(1 DIV (3 - id) AS string) value")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        P.write_lines(lines, str(tmp_path / "p"))
    assert not list((tmp_path / "p").iterdir())


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    lines = spark.range(0, 200, 1, 1).selectExpr("'S' || lpad(id, 3, '0') symbol", "'x' value")
    P.write_lines(lines, str(tmp_path / "p"))
    tracker, before = spark.sparkContext.statusTracker(), spark.conf.get(P.LISTING)
    spark.sparkContext.setJobGroup("listing", "")
    P.rejected_price_files(spark, str(tmp_path / "p"), partitioned=True)
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tracker.getStageInfo(s).numTasks for s in stages] == [4 * spark.sparkContext.defaultParallelism]
    assert spark.conf.get(P.LISTING) == before


def test_symbols_are_read_from_paths(spark, tmp_path):
    lines = spark.range(0, 3, 1, 1).selectExpr("'S' || id symbol", "'x' value")
    P.write_lines(lines, str(tmp_path / "p"))
    # Spark's discovery of folders, which takes time by the square of their number, refuses those of different depth.
    for folder in ("symbol=50%", "exchange=N/symbol=A"):
        (tmp_path / "p" / folder).mkdir(parents=True)
        (tmp_path / "p" / folder / "a.csv").write_text("x")
    rejected = P.rejected_price_files(spark, str(tmp_path / "p"), partitioned=True)
    assert sorted(r.symbol for r in rejected.collect()) == ["50%", "A", "S0", "S1", "S2"]
    assert [r.symbol for r in rejected.where("symbol = 'S1'").collect()] == ["S1"]
    (tmp_path / "empty").mkdir()
    assert P.rejected_price_files(spark, str(tmp_path / "empty"), partitioned=True).collect() == []


def test_local_folder(spark):
    from tidegrid.session import local_folder

    given = ["/a/b", "file:/a/b", "file:///a b%20", "a/b", "file://host/a", "hdfs://host/a", "viewfs:///a"]
    assert [local_folder(spark, g) for g in given] == ["/a/b", "/a/b", "/a b%20", None, None, None, None]
