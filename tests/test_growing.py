"""Lines of files that grow, rotate and are written anew."""

import os

import pytest

from campaignlake.sources import growing


def read(spark, root):
    q = (growing.growing_lines(spark, f"{root}/in").writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted((r["value"], r["position"]) for r in spark.read.parquet(f"{root}/out").collect())


@pytest.fixture
def root(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(root, name, text, mode="a"):
    with open(root / "in" / name, mode, newline="") as f:
        f.write(text)


@pytest.mark.parametrize("split", [7, 1 << 20])
def test_every_line_once(spark, root, monkeypatch, split):
    monkeypatch.setattr(growing, "SPLIT", split)
    put(root, "a.csv", "h;x\n1;" + "a" * 30 + "\n\n2;b\r\n3;par")
    put(root, ".hidden", "no\n")
    put(root, "empty.csv", "")
    first = [("", 37), ("1;" + "a" * 30, 4), ("2;b", 38), ("h;x", 0)]
    assert read(spark, root) == first
    put(root, "a.csv", "tial\n4;ü\n5")
    put(root, "b.csv", "h;x\n")
    second = sorted([*first, ("3;partial", 43), ("4;ü", 53), ("h;x", 0)])
    assert read(spark, root) == second
    # rotated while it grows, and a new file under the old name
    put(root, "a.csv", "five\n")
    os.rename(root / "in/a.csv", root / "in/a.csv.1")
    put(root, "a.csv", "h;x\n6;new\n")
    third = sorted([*second, ("5five", 58), ("h;x", 0), ("6;new", 4)])
    assert read(spark, root) == third
    # written anew, shorter
    put(root, "a.csv", "7\n", "w")
    fourth = sorted([*third, ("7", 0)])
    assert read(spark, root) == fourth and read(spark, root) == fourth


def test_a_repeated_batch_finds_rotated_files(spark, root):
    reader = growing._source()({"path": str(root / "in")}).streamReader(None)
    put(root, "a.csv", "1\n2\n")
    start = reader.latestOffset()
    put(root, "a.csv", "3\n")
    end = reader.latestOffset()
    # the stream ended before this batch was committed, and the file was rotated since
    os.rename(root / "in/a.csv", root / "in/a.csv.1")
    put(root, "a.csv", "4\n")
    parts = reader.partitions(start, end)
    assert [(p.path.rsplit("/", 1)[1], p.begin, p.end) for p in parts] == [("a.csv.1", 4, 6)]
    assert [v for p in parts for b in reader.read(p) for v in b.column(0).to_pylist()] == ["3"]
    after = reader.partitions(end, reader.latestOffset())
    assert [v for p in after for b in reader.read(p) for v in b.column(0).to_pylist()] == ["4"]


def test_a_lost_file_is_an_error(spark, root):
    reader = growing._source()({"path": str(root / "in")}).streamReader(None)
    put(root, "a.csv", "1\n")
    end = reader.latestOffset()
    assert [(p.begin, p.end) for p in reader.partitions({}, end)] == [(0, 2)]
    put(root, "a.csv", "x", "w")
    with pytest.raises(ValueError, match="a.csv"):
        reader.partitions({}, end)
