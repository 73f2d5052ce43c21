"""Line numbers over many splits, reference files, the batch checksum."""

import csv
import io

import pytest
from pyspark.sql import functions as F

from workledger.session import materialize
from workledger.sources.checksum import batch_checksum, line_digest
from workledger.sources.lines import number_rows, scan_lines
from workledger.sources import records, references
from workledger.sources.references import read_stores, read_technicians


@pytest.mark.parametrize("max_broadcast", [1_000_000, 0])
def test_line_numbers_over_many_splits(spark, tmp_path, max_broadcast):
    contents = {}
    for i, end in ((1, "\n"), (2, "\r\n")):
        lines = [f"line {n} " + "x" * (n % 37) if n % 11 else "" for n in range(3000)]
        (tmp_path / f"work_order_events_0{i}.jsonl").write_text(end.join(lines), newline="")
        contents[f"work_order_events_0{i}.jsonl"] = lines
    (tmp_path / "other.jsonl").write_text("not an event file\n")
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scanned = scan_lines(spark, str(tmp_path))
        assert scanned.select("source_file", "block_start").distinct().count() > 10
        written = materialize(scanned, "lines")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    rows = number_rows(written, max_broadcast=max_broadcast).collect()
    found = {(row.source_file, row.source_row_number): row.raw for row in rows}
    expected = {(name, n): line for name, lines in contents.items() for n, line in enumerate(lines, start=1)}
    assert found == expected and len(rows) == len(expected)


def test_line_numbers_run_on_over_part_files(spark, tmp_path):
    folder = tmp_path / "work_order_events_07.jsonl"
    lines = spark.range(500).selectExpr("cast(id as string) as raw", "id")
    lines.repartitionByRange(4, "id").sortWithinPartitions("id").select("raw").write.text(str(folder))
    rows = number_rows(materialize(scan_lines(spark, str(tmp_path)), "lines"))
    assert rows.filter(F.col("source_row_number") != F.col("raw").cast("int") + 1).count() == 0
    assert rows.select("source_file").distinct().collect()[0][0] == folder.name


def test_no_event_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="work_order_events"):
        scan_lines(spark, str(tmp_path))


def test_reference_rows(spark, tmp_path):
    (tmp_path / "stores.csv").write_text(
        "store_id,client_id,store_number,region,active_flag,extra\n"
        "S1,C1,1,North,TRUE,x\n"
        " ,C1,2,North,TRUE,x\n"
        "S2,C1,3,North,maybe,x\n"
        'S3, C1 ,4,"North, ""A""",false,x\n'
        "S1,C2,5,South,FALSE,x\n"
        "S4,C2\n"
        "S5,,6,,TRUE,x\n"
        'S6,C3,7,"North\nWest",TRUE,x\n'
        "S7,C3,8,South,no,x\n"
    )
    stores = read_stores(spark, str(tmp_path))
    assert {tuple(row) for row in stores.clean.collect()} == {
        ("S1", "C2", "5", "South", "FALSE"),
        ("S3", "C1", "4", 'North, "A"', "false"),
        ("S5", "", "6", "", "TRUE"),
        ("S6", "C3", "7", "North\nWest", "TRUE"),
    }
    rejects = {row.source_row_number: (row.source_file, row.reason) for row in stores.rejects.collect()}
    assert rejects == {
        3: ("stores.csv", "missing store_id"),
        4: ("stores.csv", "active_flag must be TRUE or FALSE"),
        7: ("stores.csv", "active_flag must be TRUE or FALSE"),
        10: ("stores.csv", "active_flag must be TRUE or FALSE"),
    }


def test_missing_key_column_is_an_error(spark, tmp_path):
    (tmp_path / "technicians.csv").write_text("name,active_flag\nA,TRUE\n")
    with pytest.raises(ValueError, match="technicians.csv is missing required column technician_id"):
        read_technicians(spark, str(tmp_path))


def test_checksum_depends_on_content_and_not_on_layout(spark):
    def checksum(rows, partitions=1):
        df = spark.createDataFrame(rows, "source_file string, source_row_number bigint, raw string")
        lines = df.repartition(partitions).withColumn("digest", line_digest(F.col("raw")))
        return batch_checksum(lines).first()[0]

    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x")]
    assert checksum(rows) == checksum(rows[::-1], 3)
    assert len(checksum(rows)) == 64
    others = [
        rows[:2],
        [("a", 1, "y"), ("a", 2, "x"), ("b", 1, "x")],
        [("a", 1, "x"), ("a", 2, "y"), ("c", 1, "x")],
        rows + [("b", 2, "")],
    ]
    assert len({checksum(rows), *(checksum(other) for other in others)}) == 5


NASTY = (
    'store_id,region,flag\nS1,"a\nb",c\nS2,"x ""q""\n\n\ny",z\n\nS3,plain,5" pipe\r\nS4,"full","q,\nr"\nS5\nS6,"",\nS7,"",""\nS8,"1,""\n"\n',
    'store_id,"re\ngion",flag\r\n1,"a\r\nb",2\r\n3,4,"5\n"\n"6\n7",,\n8,9,x',
    "store_id,region,flag\n",
)


def read_by_python(text):
    rows = [row for row in csv.reader(io.StringIO(text, newline="")) if row]
    return [(n, *[*row, "", ""][:3]) for n, row in enumerate(rows[1:], 2)]


@pytest.mark.parametrize("split", [7, 1000])
def test_reference_files_by_splits(spark, tmp_path, monkeypatch, split):
    """Every border of a split meets a quoted break, a quote or a record's end in one of the files."""
    write = records.materialize

    def write_scan(df, label):  # only the scan of the text is split
        if label == "lines":
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            try:
                df = df.select("*")
                assert split == 1000 or df.rdd.getNumPartitions() > 3
                return write(df, label)
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
        return write(df, label)

    monkeypatch.setattr(records, "materialize", write_scan)
    for n, text in enumerate(NASTY):
        for shift in range(2 if split < 1000 else 1):
            folder = tmp_path / f"{n}-{shift}"
            folder.mkdir()
            text = text.replace("plain", "plain" + "x" * shift).replace("1,", "1" * (1 + shift) + ",", 1)
            (folder / "stores.csv").write_bytes(text.encode())
            rows = references.scan_reference(spark, str(folder), "stores.csv", "store_id").collect()
            assert sorted((r.source_row_number, *[v or "" for v in r[:3]]) for r in rows) == read_by_python(text)


def test_reference_parts_are_numbered_on(spark, tmp_path):
    folder = tmp_path / "stores.csv"
    folder.mkdir()
    for n, rows in enumerate(['S1,"a\n\nb"\nS2,b\n', "", "S3,c\n\nS4,d\n"]):
        (folder / f"part-0000{n}.csv").write_text("store_id,region\n" + rows)
    rows = references.scan_reference(spark, str(tmp_path), "stores.csv", "store_id").collect()
    found = sorted((r.source_row_number, r.store_id, r.region, r.source_file) for r in rows)
    assert found == [(2, "S1", "a\n\nb", "stores.csv"), (3, "S2", "b", "stores.csv"), (4, "S3", "c", "stores.csv"), (5, "S4", "d", "stores.csv")]
