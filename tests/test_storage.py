"""Sources and sinks that are read back, and runs that go on from before."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import documents, sinks
from tessera.streaming import incremental


def test_broken_lines_stop_nothing(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1, "s": "x"}\n{"k": 2, "s"\nnonsense\n\n{"k": "no number", "s": "y"}\n')
    (tmp_path / "b.json").write_text('{"k": 3}\n')
    (tmp_path / "c.json").write_text("")
    rows = documents.json_rows(spark, str(tmp_path), "k int, s string")
    assert sorted((r.k, r.s) for r in rows.filter("error IS NULL AND k IS NOT NULL").collect()) == [(1, "x"), (3, None)]
    got = {r.file.rsplit("/", 1)[1]: (r.records, r.errors) for r in documents.scan_report(rows).collect()}
    assert got["b.json"] == (1, 0) and got["a.json"][1] == 3 and "c.json" not in got


def test_published_partitions_are_replaced_and_verified(spark, tmp_path):
    path, row = str(tmp_path / "p"), "k string, v int, t string"
    sinks.publish(spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("01", 3, "y")], row), path, "k")
    sinks.publish(spark.createDataFrame([("a", 9, "z"), ("c", 4, None)], row), path, "k")
    assert sorted((r.k, r.v, r.t) for r in sinks.published(spark, path, "k").collect()) == [("01", 3, "y"), ("a", 9, "z"), ("c", 4, None)]
    good = lambda: {r.k: (r.rows, r.good) for r in sinks.verified(spark, path, "k").collect()}
    assert good() == {"01": (1, True), "a": (1, True), "c": (1, True)}
    spark.createDataFrame([("a", 7, "late")], row).write.mode("append").partitionBy("k").parquet(path + "/data")
    assert good() == {"01": (1, True), "a": (2, False), "c": (1, True)}


def test_quoted_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    rows = [('a "b", c', 1), ("two\nlines\r\nand \\", 2), (None, 3), ("'; é", None)]
    sinks.write_quoted_csv(spark.createDataFrame(rows, "x string, y int"), str(tmp_path / "c"))
    got = sinks.read_quoted_csv(spark, str(tmp_path / "c"), "x string, y int").collect()
    assert sorted(map(str, ((r.x.replace("\r\n", "\n") if r.x else r.x, r.y) for r in got))) == sorted(map(str, ((x.replace("\r\n", "\n") if x else x, y) for x, y in rows)))


def test_a_batch_that_comes_again_replaces_its_own(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b")], "chunk_id int, t string").withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000))).write.parquet(src)
    for n in range(2):  # the second run has lost its checkpoint and begins anew
        stream = incremental.new_chunks(spark, src, "chunk_id int, t string, ts timestamp")
        incremental.run(stream, lambda b: b.select("chunk_id"), out, str(tmp_path / f"ck{n}")).awaitTermination()
    assert sorted((r.chunk_id, r.batch) for r in incremental.results(spark, out).collect()) == [(1, 0), (2, 0)]


@pytest.mark.parametrize("seed", range(2))
def test_names_are_found_anywhere(spark, seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abC_") for _ in range(n))
    names = sorted({word(r.randrange(0, 7)) for _ in range(60)})
    stems = sorted({word(r.randrange(0, 9)) for _ in range(40)})
    got = {x.name: x.file for x in documents.associate(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(s,) for s in stems], "stem string"), "name", "stem").collect()}
    lower = {}
    for s in stems:
        lower.setdefault(s.lower(), s)
    for n in names:
        fits = [p for p in lower if (p in n.lower() or n.lower() in p)]
        want = min(fits, key=lambda p: (p != n.lower(), len(p), p), default=None)
        assert got[n] == (None if want is None else lower[want]), n
    assert len(got) == len(names)
