"""Beginnings of files and quoted line ends, read by Spark's readers in many tasks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from kpiloom.sources import delimited as dl

LAYOUT = dl.Layout(",", ("a", "b", "c"))


def odd_table(seed: int, rows: int, ends: str) -> str:
    """Rows with separators, quotes and line ends in their cells, some cells over many lines."""
    rng = random.Random(seed)

    def cell():
        kind = rng.random()
        if kind < 0.5:
            return rng.choice(["x", "", "5 in", "a b", "é"])
        if kind < 0.6:
            return "\n".join(rng.choice(["", "line", 'say ""', "1,2", '"']) for _ in range(rng.randrange(2, 40)))
        return rng.choice(["two\nlines", "with, comma", 'with "quotes"', '"', '","', "\n", 'end"\n"start', "a,\nb\n,c"])

    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ends)
    writer.writerow(LAYOUT.header)
    for i in range(rows):
        writer.writerow([str(i), cell(), cell()])
    return out.getvalue()


def collected(df):
    return sorted(map(str, map(tuple, df.select("a", "b", "c").collect())))


@pytest.mark.parametrize("size, ends", [(300, "\n"), (700, "\r\n"), (5000, "\n")])
def test_quoted_line_ends_are_read_by_many_tasks(spark, text_file, size, ends):
    paths = [text_file(f"t{seed}.csv", odd_table(seed, 80, ends)) for seed in range(2)] + [text_file("plain.csv", f'a,b,c{ends}p,5" pipe,"q"{ends}')]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        got = dl.read_layout(spark, paths, LAYOUT)
        want = dl.read_layout(spark, paths, LAYOUT, multiline=True)
        assert collected(got) == collected(want) and got.count() == 161
        assert sorted(r.source_file for r in got.select("source_file").distinct().collect()) == ["plain.csv", "t0.csv", "t1.csv"]
        lines = dl._lines(spark, paths[:1])
        assert lines.select(F.spark_partition_id()).distinct().count() > (3 if size < 5000 else 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_without_crossing_lines_are_scanned_plainly(spark, text_file):
    plain = text_file("plain.csv", 'a,b,c\n1,5" pipe,"q"\n2,"x ""y""",z"\n')
    assert dl.entered_splits(spark, [plain], ",") == {}
    crossing = text_file("crossing.csv", 'a,b,c\n1,5" pipe,"q\nr"\n')
    assert [k.rsplit("/", 1)[1] for k in dl.entered_splits(spark, [plain, crossing], ",")] == ["crossing.csv"]
    # an even number of quotes, and yet the line ends inside one
    assert collected(dl.read_delimited(spark, [plain, crossing])) == sorted(map(str, [("1", '5" pipe', "q"), ("2", 'x "y"', 'z"'), ("1", '5" pipe', "q\nr")]))


def test_an_open_quote_at_the_end_of_a_file(spark, text_file):
    path = text_file("open.csv", 'a,b,c\n1,2,3\n4,"never closed\n5,6,7\n')
    assert [r.a for r in dl.read_delimited(spark, path).orderBy("a").collect()] == ["1", "4"]


@pytest.mark.parametrize("line, entered_out, entered_in", [
    ("a,b", False, True), ('"a', True, False), ('a"', False, False), ('"a""b",c', False, False), ('x,"y', True, False), ('5" pipe,"open', True, True),
    ('","', False, True), ('""', False, True), ('"x"y,"z', True, True), ('"a"\r', False, False), ("", False, True),
])
def test_states_of_lines(line, entered_out, entered_in):
    assert dl.ends_open(line, False, ",") == entered_out
    assert dl.ends_open(line, True, ",") == entered_in


def test_beginnings_are_read_by_the_reader(spark, text_file, tmp_path, monkeypatch):
    big = text_file("big.csv", "a,b\n" + "1,2\n" * 50_000)
    same = [text_file(f"same {i}.csv", f"a,b\n{i},x\n") for i in range(5)]
    other = text_file("other.csv", "b;a\nx;9\n")
    empty = text_file("empty.csv", "")
    groups, failed = dl.layouts_of(spark, [f"file://{p}" for p in (big, *same, other, empty)])
    assert {k: len(v) for k, v in groups.items()} == {dl.Layout(",", ("a", "b")): 6, dl.Layout(";", ("b", "a")): 1}
    assert list(failed) == [f"file://{empty}"] and "no lines" in failed[f"file://{empty}"]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"
    monkeypatch.setattr(dl, "MOST_HEADER_CHARS", 1000)
    with pytest.raises(dl.LoadError, match="1000 characters"):
        dl.read_delimited(spark, text_file("wide.csv", ",".join(f"column{i}" for i in range(300)) + "\n1\n"))


def test_a_long_header_is_read_whole(spark, text_file):
    names = [f"column_{i}" for i in range(30_000)]
    groups, _ = dl.layouts_of(spark, [text_file("wide.csv", ",".join(names) + "\n")])
    assert list(groups)[0].header == tuple(names)
