"""Records of text files against Python's own CSV reader."""

import csv
import io
import random
from pathlib import Path

import pytest

from salescope.operators import validate as V
from salescope.sources import text as X


def write(folder, files):
    folder.mkdir()
    for name, body in files.items():
        (folder / name).write_bytes(body.encode())
    return str(folder)


def brute(body):
    """(fields) of every record, as the reader with a quote and no escape takes them."""
    return [tuple(r) if r else ("",) for r in csv.reader(io.StringIO(body, newline=""), delimiter=";")]


def parsed(spark, records, widths):
    got = {}
    for w in set(widths.values()):
        part = records.where(records.record_no.isin([k for k, x in widths.items() if x == w]))
        for r in V.split_fields(part, [f"f{i}" for i in range(w)]).collect():
            got[r.record_no] = tuple(r[f"f{i}"] for i in range(w))
    return got


PIECES = ["a", "", 'x"y', '"q"', '"a;b"', '"l\ne"', '"l\r\ne"', '"d""d"', '"""\n;"', '"q"z', '"q"z"w', " ", "é", '"\n\n"', '""']


@pytest.mark.parametrize("seed,size", [(1, 1 << 20), (2, 60), (3, 13)])
def test_records_equal_the_csv_reader(spark, tmp_path, seed, size):
    r = random.Random(seed)
    files = {f"part-{k}.csv": "".join(
        ";".join(r.choice(PIECES) for _ in range(r.randint(1, 4))) + r.choice(["\n", "\r\n"]) for _ in range(16)) for k in range(3)}
    files["part-0.csv"] = "h1;h2\n" + files["part-0.csv"]
    path = write(tmp_path / "in", files)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        header, records = X.read_delimited(spark, path)
        want = [rec for name in sorted(files) for rec in brute(files[name])][1:]
        widths = {k: len(rec) for k, rec in enumerate(want, 1)}
        assert header == ["h1", "h2"] and records.count() == len(want)
        assert parsed(spark, records, widths) == dict(enumerate(want, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_record_over_many_splits_and_an_open_quote(spark, tmp_path):
    long = "h\n" + 'a;"' + "x;\n" * 200 + 'end";b\nlast;"never closed\nmore\n'
    path = write(tmp_path / "in", {"one.csv": long})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        _, records = X.read_delimited(spark, path)
        got = {r.record_no: r.line for r in records.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {1: 'a;"' + "x;\n" * 200 + 'end";b', 2: 'last;"never closed\nmore'}


def test_order_of_files_headings_and_chunks(spark, tmp_path):
    files = {f"f{k}.csv": "﻿x;y\n" + "".join(f"{k};{i}\n" for i in range(n)) for k, n in enumerate([5, 0, 300, 7])}
    path = write(tmp_path / "in", files)
    header, records = X.read_delimited(spark, path, header_per_file=True)
    want = [f"{k};{i}" for k, n in enumerate([5, 0, 300, 7]) for i in range(n)]
    assert header == ["x", "y"] and [r.line for r in records.orderBy("record_no").collect()] == want
    assert sorted(r.record_no for r in X.head_n(records, 9).collect()) == list(range(1, 10))
    profile = X.volume_profile(records, 100, header).orderBy("chunk_index").collect()
    assert [r.rows for r in profile] == [100, 100, 100, 12] and profile[0].total == 312 and profile[0].header == "x;y"
    lines = {r.ordinal: r.line for r in X.numbered_lines(spark, path).collect()}
    assert len(lines) == 316 and lines[1] == "0;0" and lines[315] == "3;6"


def test_empty_input_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        X.read_delimited(spark, write(tmp_path / "in", {"none.csv": ""}))


def test_files_without_quotes_are_numbered_without_a_shuffle_of_lines(spark, tmp_path):
    path = write(tmp_path / "in", {"a.csv": "h;k\n" + "1;2\n" * 50, "b.csv": '3;"q;r"\n'})
    _, records = X.read_delimited(spark, path)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert records.count() == 51 and "Window" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("suffix", ["csv", "parquet"])
def test_valid_rows_keep_input_order_and_come_back(spark, tmp_path, suffix):
    from salescope.sources.sinks import write_rows
    products = ['a', 'b;c', 'say "hi"', 'two\nlines', ' x ', '']
    rows = [(k, products[k % 6], str(k)) for k in range(500)]
    df = spark.createDataFrame(rows, "record_no long, product string, units string").repartition(7, "units")
    path = f"{tmp_path}/valid.{suffix}"
    write_rows(df, path, order_by="record_no")
    back = X.read_rows(spark, path)
    assert back.columns == ["product", "units"]
    assert sorted((tuple(r) for r in back.collect()), key=lambda r: int(r[1])) == [r[1:] for r in rows]
    if suffix == "csv":
        parts = sorted(p for p in (tmp_path / "valid.csv").iterdir() if p.name.startswith("part-"))
        body = "".join(p.read_text() for p in parts)
        assert body.count("PRODUCTO;UNIDADES") == 1
        assert [tuple(r) for r in csv.reader(io.StringIO(body, newline=""), delimiter=";")] == [("PRODUCTO", "UNIDADES")] + [r[1:] for r in rows]
    else:
        parts = [spark.read.parquet(str(p)).collect() for p in sorted((tmp_path / "valid.parquet").glob("part-*"))]
        assert [r[1] for part in parts for r in part] == [str(k) for k in range(500)]


def test_quarantine_file_with_its_heading(spark, tmp_path):
    from salescope.sources.sinks import QUARANTINE_HEADING, write_quarantine
    lines = spark.createDataFrame([(k, f"{k}:{'RUN' if k % 3 else 'EDAD'}:regla:v") for k in range(100)], "record_no long, line string")
    write_quarantine(lines.repartition(5), f"{tmp_path}/q")
    parts = sorted((tmp_path / "q").glob("part-*"))
    body = "".join(p.read_text() for p in parts).splitlines()
    assert body[:2] == QUARANTINE_HEADING and [int(x.split(":")[0]) for x in body[2:]] == list(range(100))
    got = {r["reason"]: r["n"] for r in V.discard_summary(spark.read.text(f"{tmp_path}/q"), "value").collect()}
    assert got == {"EDAD": 34, "RUN": 66, "total": 100}


def test_plain_records_need_one_join_and_quotes_one_pass(spark, tmp_path):
    from salescope.sources import text as TX
    for name, body in (("plain", "a;b\r\n\n1;2\"\n3;4"), ("quoted", 'a;b\n1;"x\ny"\n2;"p\n"q;"\nr"\n3;z\r\n')):
        (tmp_path / name).write_bytes(body.encode())
    records = TX.numbered_records(TX.scan_lines(spark, f"{tmp_path}/plain"))
    assert sorted((r["ordinal"], r["text"]) for r in records.collect()) == [(0, "a;b"), (1, ""), (2, '1;2"'), (3, "3;4")]
    assert records._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    quoted = TX.numbered_records(TX.scan_lines(spark, f"{tmp_path}/quoted"))
    assert sorted((r["ordinal"], r["text"]) for r in quoted.collect()) == [
        (0, "a;b"), (1, '1;"x\ny"'), (2, '2;"p\n"q;"\nr"'), (3, "3;z")]
    assert TX._splits(TX.scan_lines(spark, f"{tmp_path}/plain"), ";")._jdf.queryExecution().optimizedPlan().toString().count("text") == 0


def test_rows_of_a_text_file_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from salescope.plans import views as W
    n = 1000
    spark.range(n).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(W, "LINES_A_FILE", 50)
    rows = spark.range(n).select(F.when(F.col("id") > 2, F.col("id")).alias("record_no"), F.concat(F.lit("r"), "id").alias("line"))
    path = W.written_text(spark, "some", str(tmp_path), lambda: rows, ["head"])
    parts = [[r.value for r in spark.read.text(str(p)).collect()] for p in sorted(Path(path).glob("part-*"))]
    assert [x for part in parts for x in part] == ["head", *(f"r{k}" for k in range(n))]
    assert len(parts) > 15 and max(map(len, parts)) < 120
