"""Structured Streaming validate-and-route on the 28-row fixture."""

import os
import tempfile

from pyspark.sql import functions as F

from salescope.sources.sinks import write_dealt_lines
from salescope.streaming.validate_stream import validate_stream
from tests.test_validate import FIXTURE


def _source(d):
    """The fixture in three files, each with the heading, one of them with a record over several lines."""
    head, *lines = FIXTURE.strip("\n").split("\n")
    os.makedirs(f"{d}/in")
    for k in range(3):
        with open(f"{d}/in/f{k}.csv", "w", encoding="utf-8", newline="") as f:
            f.write("\n".join(["\ufeff" + head, *lines[k::3]]) + "\n")


def test_stream_routes_every_line_once(spark):
    d = tempfile.mkdtemp(prefix="salescope-stream-")
    _source(d)
    totals = validate_stream(spark, f"{d}/in", f"{d}/out", f"{d}/chk", max_files_per_trigger=1)
    t = totals.agg(F.sum("read").alias("read"), F.sum("valid").alias("valid"),
                   F.sum("discarded").alias("discarded"), F.count(F.lit(1)).alias("batches")).first()
    assert (t["read"], t["valid"], t["discarded"]) == (28, 12, 16)
    assert t["batches"] == 3
    assert spark.read.parquet(f"{d}/out/valid").count() == 12
    bad = spark.read.parquet(f"{d}/out/quarantine").select("file", "record_no", "line").collect()
    assert len(bad) == 16
    # Numbers start anew in each file: record n of file k is line 3 (n - 1) + k of the fixture.
    found = {3 * (r["record_no"] - 1) + int(r["file"][-5]) + 1 for r in bad}
    assert found == set(range(1, 29)) - {1, 3, 5, 8, 11, 13, 16, 18, 20, 22, 25, 27}
    assert all(r["line"].startswith(f"{r['record_no']}:") for r in bad)
    # A restart with the same checkpoint finds nothing new and writes nothing twice.
    again = validate_stream(spark, f"{d}/in", f"{d}/out", f"{d}/chk")
    assert again.agg(F.sum("read")).first()[0] == 28
    # A new file with a record over two lines is one more batch.
    head, line = FIXTURE.split("\n")[:2]
    parts = line.split(";")
    parts[3] = '"DOS\nLINEAS; ""X"""'
    with open(f"{d}/in/late.csv", "w", encoding="utf-8", newline="") as f:
        f.write(head + "\r\n" + ";".join(parts) + "\r\n")
    more = validate_stream(spark, f"{d}/in", f"{d}/out", f"{d}/chk")
    assert more.agg(F.sum("read"), F.sum("valid")).first()[:] == (29, 13)
    assert spark.read.parquet(f"{d}/out/valid").where("product LIKE 'DOS%'").first()["product"] == 'DOS\nLINEAS; "X"'


def test_lines_are_dealt_without_an_exchange(spark, monkeypatch):
    """A task writes its own files, each with a heading, packed; the stream reads them as it reads plain ones."""
    d = tempfile.mkdtemp(prefix="salescope-dealt-")
    head, *lines = FIXTURE.strip("\n").split("\n")
    rows = spark.createDataFrame([(k % 3, x) for k, x in enumerate(lines)], "file long, line string").repartition(2)
    monkeypatch.setattr(type(rows), "repartition", None)
    write_dealt_lines(rows, f"{d}/in", "file", [0, 1, 2], head, compression="lz4")
    files = [f"{p}/{f}" for p, _, names in os.walk(f"{d}/in") for f in names if f.startswith("part-")]
    assert len(files) == 6 and all(f.endswith(".lz4") for f in files)
    first = {spark.read.text(f).first()[0] for f in files}
    assert first == {head}
    assert sorted(r[0] for r in spark.read.text(f"{d}/in").select("value").collect()) == sorted([head] * 6 + lines)
    stored = []
    monkeypatch.setattr(type(rows), "persist", lambda self, *level: stored.append(level) or self)
    totals = validate_stream(spark, f"{d}/in/*", f"{d}/out", f"{d}/chk", max_files_per_trigger=3)
    assert totals.agg(F.sum("read"), F.sum("valid"), F.sum("discarded"), F.count("*")).first()[:] == (28, 12, 16, 2)
    assert not stored


def test_intermediate_tables_are_packed(spark):
    from salescope.session import written
    files = [f for _, _, names in os.walk(written(spark.range(9), "packed").inputFiles()[0].removeprefix("file://").rpartition("/")[0]) for f in names]
    assert any(f.endswith(".zstd.parquet") for f in files)
