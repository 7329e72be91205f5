"""Large files over many tasks against the same text in one row."""

import random

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.text import split_lines
from tidegrid.sources import csvtext as C
from tidegrid.sources.lines import block_lines, read_lines

SMALL = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_blocks(spark):
    """Files in blocks of a few hundred bytes."""
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(folder, texts):
    folder.mkdir()
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    return str(folder)


def csv_text(seed, rows, end="\n", quoted=0.4):
    r = random.Random(seed)

    def field():
        if r.random() < quoted:
            return '"' + "".join(r.choice(["a", "é", ",", "\n", '""', '\\"', "\\\\", "\r\n", " ", "\n\n"]) for _ in range(r.randint(0, 9))) + '"'
        return "".join(r.choice(["x", "y", "7", "\\,", "\\\n", "é", "\\\\", " "]) for _ in range(r.randint(0, 6)))

    return end.join(",".join(field() for _ in range(r.choice([3, 3, 3, 2, 1, 4]))) + r.choice(["", "", end]) for _ in range(rows))


def whole(spark, texts):
    return spark.createDataFrame(list(texts.items()), "name string, body string")


def by_file(frame, *columns):
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    return sorted((tuple(r) for r in frame.select(name, *columns).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"esc": ""}, {"header": True, "offset": 2, "count": 40}])
def test_files_in_blocks_give_the_rows_of_whole_texts(spark, tmp_path, small_blocks, options):
    texts = {f"{i}.csv": csv_text(i, 150, "\r\n" if i == 2 else "\n", 0.1 * i) for i in range(6)}
    texts |= {"bom.csv": "﻿a,b\n\n1,2\n", "empty.csv": "", "one.csv": "x", "gaps.csv": "\n\r\n\na,b,c\n\n", "late.csv": 'a,b\n﻿c,"d\n﻿"\n'}
    if options.get("esc") is None:
        texts["long.csv"] = 'a,"' + "line\n" * 1500 + '",c\nd,e,f\n' + 'g,"' + "\\\\\n" * 900 + '",h'
    path = write(tmp_path / "csv", texts)
    assert block_lines(spark, path).select("path", "block").distinct().count() > 25
    found = C.parse_csv_files(spark, path, **options)
    want = C.parse_csv(whole(spark, texts), "body", **options)
    assert by_file(found, "row_no", "fields") == sorted((tuple(r) for r in want.collect()), key=repr)
    plain = {k: v for k, v in options.items() if k == "esc"}
    wide = C.csv_files_quarantine(spark, path, **plain).where("NOT broken")
    want = C.csv_quarantine(whole(spark, texts), "body", **plain).where(F.col("n_fields") > F.col("width"))
    broken = {r.name for r in C._rows(whole(spark, texts), "body", "\n", ",", options.get("esc", "\\")).where("broken").collect()}
    want = sorted((tuple(r) for r in want.select("name", "row_no", "fields", "n_fields").collect() if r.name not in broken), key=repr)
    assert [r for r in by_file(wide, "row_no", "fields", "n_fields") if r[0] not in broken] == want


def test_an_open_quote_over_many_blocks(spark, tmp_path, small_blocks):
    texts = {"open.csv": "a,b\n1,2\n3,\"4\n" + "5,6\n" * 2000, "closed.csv": "a,b\n" + "5,6\n" * 2000}
    path = write(tmp_path / "csv", texts)
    assert by_file(C.parse_csv_files(spark, path).groupBy("path").count(), "count") == [("closed.csv", 2001), ("open.csv", 2)]
    held = C.csv_files_quarantine(spark, path).collect()
    assert [(r.row_no, r.lines, r.broken, r.fields[0]) for r in held] == [(2, 2001, True, "3")]


def test_lines_stay_in_their_tasks(spark, tmp_path, small_blocks):
    """Blocks are joined to lines without a shuffle of these; one file is many tasks."""
    path = write(tmp_path / "csv", {"a.csv": "a,b\n" * 2000})
    for frame in (C.parse_csv_files(spark, path), read_lines(spark, path)):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    single = C._file_records(C._marked(spark, path, "\n", "\\"), C._file_blocks(spark, path, "\n", "\\"), "\n")
    assert single.rdd.getNumPartitions() > 5


@pytest.mark.parametrize("width", [None, 12])
def test_lines_of_files(spark, tmp_path, small_blocks, width):
    r = random.Random(3)
    line = lambda: "".join(r.choice(["ab ", "é", "longer ", "\r", ""]) for _ in range(r.randint(0, 12)))
    texts = {f"{i}.txt": "\n".join(line() for _ in range(400)) + "\n" * (i % 2) for i in range(3)} | {"bom.txt": "﻿a\n\n﻿b", "none.txt": "", "wide.txt": "word " * 4000}
    path = write(tmp_path / "t", texts)
    want = split_lines(whole(spark, {k: v for k, v in texts.items() if v}), "body", width)
    assert by_file(read_lines(spark, path, width), "line_no", "line") == sorted((tuple(r) for r in want.collect()), key=repr)


def test_records_of_several_lines_take_one_pass(spark, tmp_path):
    # Alone, over several lines, and cut off by a quote that is never closed.
    (tmp_path / "a.csv").write_text('1,x\n2,"y\nz"\n3,w\n4,"open\nrest\n')
    rows = C._file_rows(spark, str(tmp_path), "\n", ",", "\\")
    found = sorted((r.row_no, r.parts, r.broken, tuple(r.fields)) for r in rows.collect())
    assert [f[:3] for f in found] == [(0, 1, False), (1, 2, False), (2, 1, False), (3, 2, True)]
    assert found[1][3] == ("2", "y\nz")
    # Lines are read once for records of one line and once for all others.
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2


def test_records_within_a_block_are_put_together_by_its_task(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\n""y"""\n2,z\n' * 500)
    rows = C._file_rows(spark, str(tmp_path), "\n", ",", "\\")
    found = sorted((r.row_no, r.parts, tuple(r.fields)) for r in rows.collect())
    assert found[:2] == [(0, 2, ("1", 'x\n"y"')), (1, 1, ("2", "z"))] and len(found) == 1000
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("MapInArrow") == 1


def test_first_records_behind_empty_blocks_and_odd_bytes(spark, tmp_path, small_blocks):
    folder = tmp_path / "csv"
    texts = {"late.csv": "\n" * 3000 + 'a,b\n1,"2\n3"\n4,5,6', "blank.csv": "\n" * 3000, "marks.csv": 'a\ufdd1b,c,d\n\ufdd3,"e\ufdd0"\n'}
    texts["late_cut.csv"] = "\n" * 3000 + 'a,"' + "b\n" * 900 + '"\n1,2,3\n4,5'
    path = write(folder, texts)
    (folder / "bytes.csv").write_bytes(b'a\xff,"b\xed\xa0\x80\n"\nc\xe2\x82,d\n\xf0\x9f,"\xc3"\n')
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    for found, want in (
        (C.parse_csv_files(spark, path), C.parse_csv(whole, "body")),
        (C.csv_files_quarantine(spark, path).select("path", "row_no", "fields"), C.csv_quarantine(whole, "body").select("path", "row_no", "fields")),
    ):
        assert by_file(found, "row_no", "fields") == by_file(want, "row_no", "fields") != []
