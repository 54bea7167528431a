"""Strict CSV against a reader that goes from the first line on, with splits of a few bytes."""

import csv
import io
import random

import pytest

from codetables.sources import quoted
from codetables.sources.readers import Refusal


@pytest.fixture
def tiny_splits(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "120")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted((r["number"], *(v for k, v in r.asDict().items() if k != "number")) for r in df.collect())


@pytest.mark.parametrize(("end", "held"), [("\n", 200_000), ("\r\n", 0)])
def test_records_cross_splits(spark, tmp_path, tiny_splits, monkeypatch, end, held):
    monkeypatch.setattr(quoted, "MAX_BROADCAST_SPLITS", held)
    rng = random.Random(3)
    rows = [[str(k), rng.choice(["plain", "a, b", 'say "x"', "two\nlines", "\n\n" + "é" * 90 + "\n", '"', ""]), rng.choice(["", "z"])] for k in range(60)]
    text = io.StringIO()
    write = csv.writer(text, lineterminator=end)
    write.writerow(["code", "na\nme", "last"])
    want = []
    for k, row in enumerate(rows):
        if k % 10 == 0:
            text.write(end)  # blank lines count, and are no records
        write.writerow(row)
        want.append((text.getvalue().count("\n"), *row))
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + text.getvalue().encode())
    df = quoted.read_csv_strict(spark, str(tmp_path / "a.csv"), ["code", "na\nme"])
    assert df.columns == ["code", "na\nme", "last", "number"]
    assert rows_of(df) == want
    assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 8


@pytest.mark.parametrize(("text", "message"), [
    ("", "is empty"),
    ("x,z\n", "is empty"),
    ("x,y\n1,2\n", "a.csv has no column z"),
    ('x,z\n"a,b\n\n', "a.csv line 3: a quote is open at the end"),
    ("x,z\n1,2\n\n1\n", "a.csv line 4: the record has 1 fields, not 2"),
    ('x,z\n"1\n2",3\n4,"5"6\n', "a.csv line 4: a character follows a closing quote"),
    ('x,z\n1,2\n4,5"6\n7,"8"\n', "a.csv line 3: a quote is inside a field that isn't quoted"),
    ('x,z\n4,5"6\n7,8"\n', "a.csv line 2: a quote is inside"),
    ('x,z\n4,"5\n6"\n7,"8\n"9\n', "a.csv line 5: a character follows"),
])
def test_refusals(spark, tmp_path, text, message):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Refusal, match=message):
        quoted.read_csv_strict(spark, str(tmp_path / "a.csv"), ["x", "z"])


def test_several_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text('x,y\n"3\n",4\n')
    assert rows_of(quoted.read_csv_strict(spark, str(tmp_path))) == [(2, "1", "2"), (3, "3\n", "4")]
    (tmp_path / "c.csv").write_text("y,x\n5,6\n")
    with pytest.raises(Refusal, match="c.csv has another header than a.csv"):
        quoted.read_csv_strict(spark, str(tmp_path))
