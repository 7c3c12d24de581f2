"""The split CSV reader against Spark's one-task reader and Python's csv module."""
import csv
import random

import pytest
from aspectra.sources.csv_split import csv_records, read_csv_split, read_review_csv_split


def rows(n=400):
    rng = random.Random(5)
    words = ["plain", "two\nlines", 'say "hi"', "a,b", "", "\n\n", '"', "end\n", "ä\nö", "\n\"\n", "x" * 300, "line\n" * 90]
    return [(str(i), rng.choice(words) + rng.choice(words), rng.choice(words[:4])) for i in range(n)]


@pytest.mark.parametrize("block", ["512", "3001", "128m"])
def test_records_over_block_borders(spark, tmp_path, block):
    data = rows()
    for part in (0, 1):
        with open(tmp_path / f"r{part}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(["id", "Review Text", "note"])
            out.writerows(data[part::2])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        blocks = csv_records(spark, str(tmp_path)).select("file", "block").distinct().count()
        got = sorted((tuple(r) for r in read_csv_split(spark, str(tmp_path)).collect()), key=lambda r: int(r[0]))
        texts = sorted(r.text for r in read_review_csv_split(spark, str(tmp_path)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    plain = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    assert got == sorted((tuple(r) for r in plain.collect()), key=lambda r: int(r[0]))
    assert [r[0] for r in got] == [r[0] for r in data] and [r[1] or "" for r in got] == [r[1] for r in data]
    assert texts == sorted(r[1] for r in data if r[1])
    assert blocks > 20 if block == "512" else blocks >= 2


def test_windows_line_ends_and_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'review text,k\r\n"one\r\ntwo",1\r\n\r\nthree,2\r\n')
    (tmp_path / "b.csv").write_bytes(b"review text,k\r\n")
    (tmp_path / "c.csv").write_bytes(b"")
    assert sorted(r.text for r in read_review_csv_split(spark, str(tmp_path)).collect()) == ["one\r\ntwo", "three"]
