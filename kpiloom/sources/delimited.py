"""Delimited text files: layout detection per file, one scan per layout, everything read as text.

Files are only opened by Spark's readers, so any path Spark can open will do. Beginnings are read by a job with a task per
file that stops after the first lines; layouts are told apart on the executors, and the driver gets one row per layout.

Values in quotes may hold line ends, in files of any size, which are read by many tasks all the same. Every split tells where
its lines would leave the reader, inside or outside quotes, for either way of entering it. Put one after the other these tell
for every split how it is entered; then each split cuts its own records, and the pieces of records that cross splits are joined.
"""

from __future__ import annotations

import csv
import re
from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators.cleaning import null_sentinels
from kpiloom.session import materialized, ship_package

# Delimiters told apart, and how many lines are looked at.
DELIMITERS = ",\t;|"
HEAD_LINES = 10
#: Bytes of small files whose beginnings one task reads, and characters of a first line beyond which the file is refused.
HEAD_BYTES, MOST_HEADER_CHARS = 4 << 20, 16 << 20
#: A separator for reading lines uncut.
_NO_SEPARATOR = "\x01"
SUFFIXES = (".csv", ".tsv")

SOURCE_FILE = "source_file"
BROKEN = "malformed_record"


class LoadError(ValueError):
    """An input that cannot be read as a table."""


@dataclass(frozen=True)
class Layout:
    separator: str
    header: tuple[str, ...]

    def schema(self, *extra: str) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in (*self.header, *extra)])


@dataclass
class Batch:
    tables: dict[Layout, DataFrame] = field(default_factory=dict)
    files: dict[Layout, list[str]] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    found: int = 0

    def union(self) -> DataFrame:
        """All layouts as one table, columns matched by name, absent ones null."""
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), self.tables.values())


def detect_separator(head: list[str]) -> str:
    """The delimiter of the first lines, comma when in doubt or when the header would not split."""
    lines = [line for line in head if line.strip()]
    if not lines:
        return ","
    try:
        found = csv.Sniffer().sniff("\n".join(lines), delimiters=DELIMITERS).delimiter
    except csv.Error:
        return ","
    return found if found in lines[0] else ","


def _distinct_headers(names: list[str]) -> tuple[str, ...]:
    seen: dict[str, int] = {}
    result = []
    for name in names:
        repeat = seen.get(name, -1) + 1
        seen[name] = repeat
        result.append(name if repeat == 0 else f"{name}_duplicated_{repeat - 1}")
    return tuple(result)


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs inside."""
    names = {k: k.replace("__", ".") for k in values}
    before = {n: spark.conf.get(n, None) for n in names.values()}
    for k, v in values.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def canonical(path: str) -> str:
    """One spelling of a path, as listings and file metadata differ in theirs."""
    return re.sub("^file:/+", "file:/", unquote(path))


def heads(spark: SparkSession, paths: list[str], separator: str | None = None) -> DataFrame:
    """One row per file that has lines: path, and separator and header, or the error that kept them from being told.

    Files are read as unsplit streams of lines, each by one task that stops after the beginning; small files share a task.
    """
    ship_package(spark)
    lines = (
        spark.read.schema("value string").option("multiLine", True).option("sep", _NO_SEPARATOR).option("quote", "").option("maxCharsPerColumn", MOST_HEADER_CHARS)
        .csv(paths).select("value", F.col("_metadata.file_path").alias("path"))
    )

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[str]] = {}
        size = 0
        for batch in batches:
            path = batch.column("path")
            if not len(path):
                continue
            names = path.dictionary_encode()
            runs = np.flatnonzero(np.diff(names.indices.to_numpy(), prepend=-1))
            for at, end in zip(runs, [*runs[1:], len(path)], strict=True):
                own = found.setdefault(canonical(path[int(at)].as_py()), [])
                own += [v or "" for v in batch.column("value").slice(at, min(end - at, HEAD_LINES - len(own))).to_pylist()]
            size += pc.sum(pc.binary_length(batch.column("value"))).as_py() or 0
            # only a file that has the task to itself can be larger than this
            if size > HEAD_BYTES:
                break
        rows = []
        for name, head in found.items():
            try:
                layout = _layout(name, head, separator)
                rows.append({"path": name, "separator": layout.separator, "header": list(layout.header), "error": None})
            except LoadError as failure:
                rows.append({"path": name, "separator": None, "header": None, "error": str(failure)})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("separator", pa.string()), ("header", pa.list_(pa.string())), ("error", pa.string())]))

    told = lines.mapInArrow(tell, "path string, separator string, header array<string>, error string")
    with _settings(spark, spark__sql__files__maxPartitionBytes=str(HEAD_BYTES), spark__sql__files__openCostInBytes=str(HEAD_BYTES // 64), spark__sql__files__minPartitionNum="1"):
        try:
            return materialized(told, "heads")
        except (PySparkException, Py4JJavaError) as failure:
            raise LoadError(f"a beginning that can't be read as lines of at most {MOST_HEADER_CHARS} characters: {str(failure)[:300]}") from failure


def _layout(path: str, head: list[str], separator: str | None = None) -> Layout:
    if not any(head):
        raise LoadError(f"no lines in {path}")
    first = head[0].removeprefix("\ufeff")
    separator = separator or detect_separator([first, *head[1:]])
    return Layout(separator, _distinct_headers(next(csv.reader([first], delimiter=separator))))


def layouts_of(spark: SparkSession, paths: list[str], separator: str | None = None) -> tuple[dict[Layout, list[str]], dict[str, str]]:
    """Files by layout, and the reason for each file that has none.

    The driver gets the layouts with their number of files, and names only of files that don't have the most common one.
    """
    if not paths:
        return {}, {}
    listed = {canonical(p): p for p in paths}
    told = heads(spark, paths, separator)
    counts = sorted(told.groupBy("separator", "header", "error").agg(F.count(F.lit(1)).alias("n")).where("error IS NULL").collect(), key=lambda r: (-r.n, r.separator, r.header))
    failed = {listed[r.path]: r.error for r in told.where("error IS NOT NULL").collect()}
    groups: dict[Layout, list[str]] = {}
    others: set[str] = set(failed)
    for r in counts[1:]:
        same = (F.col("separator") == r.separator) & (F.col("header") == F.array(*[F.lit(h) for h in r.header]))
        groups[Layout(r.separator, tuple(r.header))] = sorted(listed[x.path] for x in told.where(same).select("path").collect())
        others.update(groups[Layout(r.separator, tuple(r.header))])
    if sum(r.n for r in counts) + len(failed) < len(listed):
        absent = spark.createDataFrame([(p,) for p in listed], "path string").join(told.select("path"), "path", "left_anti")
        empty = {listed[r.path]: f"no lines in {listed[r.path]}" for r in absent.collect()}
        failed |= empty
        others |= set(empty)
    if counts:
        groups[Layout(counts[0].separator, tuple(counts[0].header))] = sorted(p for p in paths if p not in others)
    return dict(sorted(groups.items(), key=lambda g: g[1])), dict(sorted(failed.items()))


def layout_of(spark: SparkSession, path: str) -> Layout:
    """Layout of one file, or of the files of a folder that a writer left; these must agree."""
    groups, failed = layouts_of(spark, files_below(spark, path))
    if failed or len(groups) != 1:
        raise LoadError(next(iter(failed.values())) if failed else f"files of {path} differ in layout: {sorted(g[0] for g in groups.values())}")
    return next(iter(groups))


def files_below(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the part files of a folder. Only the listing is read."""
    return sorted(map(unquote, spark.read.format("binaryFile").load(path).inputFiles()))


def _options(layout: Layout, multiline: bool) -> dict[str, str]:
    return {"sep": layout.separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "multiLine": str(multiline).lower()}


def _plain_read(spark: SparkSession, paths: list[str], layout: Layout, multiline: bool, header: bool) -> DataFrame:
    reader = spark.read.schema(layout.schema(BROKEN)).options(**_options(layout, multiline)).option("header", header).option("enforceSchema", True)
    return reader.csv(paths).select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))


def read_layout(spark: SparkSession, paths: list[str], layout: Layout, multiline: bool | None = None, header: bool = True) -> DataFrame:
    """Files of one layout, with the source file and the text of malformed rows.

    Files in which no line ends inside quotes are read in one splittable scan. Of the others the records are put together split
    by split (line ends are \\n or \\r\\n there) and then parsed. ``multiline`` skips the search: False says that there are no such
    files, True has every file read by one task.
    """
    if multiline is not None:
        return _plain_read(spark, paths, layout, multiline, header)
    paths = [f for p in paths for f in files_below(spark, p)]
    entered = entered_splits(spark, paths, layout.separator)
    crossing = [p for p in paths if canonical(p) in entered]
    plain = [p for p in paths if canonical(p) not in entered]
    parts = [_plain_read(spark, plain, layout, False, header)] if plain else []
    if crossing:
        parts.append(_parsed(records(spark, crossing, layout.separator, entered, header), layout))
    return reduce(DataFrame.unionByName, parts)


def ends_open(line: str, open_: bool, separator: str) -> bool:
    """Whether a line that is entered inside (open_) or outside quotes ends inside quotes.

    A quote opens a value only at its beginning; inside, two quotes are one; one that neither a separator nor the line's end
    follows makes the rest of the value plain.
    """
    line = line.removesuffix("\r")
    at, size = 0, len(line)
    while True:
        if open_:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            at, open_ = at + 1, False
        elif line.startswith('"', at):
            at, open_ = at + 1, True
            continue
        at = line.find(separator, at)
        if at < 0 or at + 1 > size:
            return False
        at += len(separator)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def entered_splits(spark: SparkSession, paths: list[str], separator: str) -> dict[str, tuple[list[int], list[bool]]]:
    """Per file with a line that ends inside quotes: starts of its splits that have quotes, and whether each is left inside quotes.

    Only lines with quotes reach Python. What is collected is one short row per split, and only of those files.
    """
    ship_package(spark)

    def transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for line, path, split in zip(*(batch.column(c).to_pylist() for c in ("value", "path", "split")), strict=True):
                # left inside quotes when entered outside, when entered inside; whether any line, entered outside, was
                state = seen.setdefault((path, split), [False, True, False])
                outside, inside = ends_open(line, state[0], separator), ends_open(line, state[1], separator)
                state[:] = [outside, inside, state[2] or outside]
        rows = [{"path": canonical(p), "split": s, "outside": v[0], "inside": v[1], "crosses": v[2]} for (p, s), v in seen.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("split", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()), ("crosses", pa.bool_())]))

    quoted = _lines(spark, paths).where(F.contains("value", F.lit('"'))).select("value", "path", "split")
    found = materialized(quoted.mapInArrow(transitions, "path string, split long, outside boolean, inside boolean, crosses boolean"), "splits")
    crossing = found.where("crosses").select("path").distinct()
    entered: dict[str, tuple[list[int], list[bool]]] = {}
    for r in found.join(crossing, "path", "left_semi").orderBy("path", "split").toLocalIterator():
        splits, left = entered.setdefault(r.path, ([], []))
        splits.append(r.split)
        left.append(r.inside if left and left[-1] else r.outside)
    return entered


def records(spark: SparkSession, paths: list[str], separator: str, entered: dict[str, tuple[list[int], list[bool]]], header: bool) -> DataFrame:
    """The records of the files as they stand, line ends in quotes included: file, record. Empty lines between records are none."""
    known = spark.sparkContext.broadcast(entered)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, began = None, True, False
        pending: list[str] | None = None
        out: list[tuple[str, str, int, int, str]] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 5
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)], ["path", "file", "split", "part", "text"])
            out.clear()
            return batch

        for batch in batches:
            for line, path, file, split in zip(*(batch.column(c).to_pylist() for c in ("value", "path", "file", "split")), strict=True):
                if at is None or at[0] != path or at[2] != split:
                    if pending is not None:
                        out.append((*at, 3 if began else 2, "\n".join(pending)))
                    at, first = (path, file, split), header and split == 0
                    splits, left = known.value.get(canonical(path), ([], []))
                    k = bisect_left(splits, split)
                    began = k > 0 and left[k - 1]  # the split begins inside a record
                    pending = [] if began else None
                if pending is None:
                    if line in ("", "\r"):
                        continue
                    pending, inside = [line], ends_open(line, False, separator)
                else:
                    pending.append(line)
                    inside = ends_open(line, True, separator) if '"' in line else True
                if not inside:
                    text, pending = "\n".join(pending), None
                    if began or not first:
                        out.append((*at, 1 if began else 0, text.removesuffix("\r")))
                    first, began = first and began, False
            if len(out) > 10_000:
                yield flush()
        if pending is not None:
            out.append((*at, 3 if began else 2, "\n".join(pending)))
        yield flush()

    # parts: 0 whole record, 1 end of a record of an earlier split, 2 beginning of one that goes on, 3 middle: the whole split
    pieces = materialized(_lines(spark, paths).mapInArrow(cut, "path string, file string, split long, part int, text string"), "records")
    whole = pieces.where("part = 0").select("file", F.col("text").alias("record"))
    # at most two pieces a split: a record is numbered by the beginnings up to it
    place = F.struct("split", F.when(F.col("part") == 2, 1).otherwise(0).alias("late"))
    upto = Window.partitionBy("path").orderBy("split", F.when(F.col("part") == 2, 1).otherwise(0)).rowsBetween(Window.unboundedPreceding, 0)
    broken = pieces.where("part <> 0").withColumn("number", F.count_if(F.col("part") == 2).over(upto))
    joined = broken.groupBy("path", "file", "number").agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "text"))).alias("texts"))
    return whole.union(joined.select("file", F.array_join("texts.text", "\n").alias("record")))


def _parsed(rows: DataFrame, layout: Layout) -> DataFrame:
    """Records as the layout's columns, beside the text of malformed ones and the source file."""
    held = rows.select(F.from_csv("record", ", ".join(f"`{n}` string" for n in (*layout.header, BROKEN)), _options(layout, True)).alias("row"), F.col("file").alias(SOURCE_FILE))
    return held.select("row.*", SOURCE_FILE)


def _fields_in(record, separator: str):
    """Fields of a raw record, separators inside quotes not counted."""
    outside = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(separator), F.lit(""))) + 1


def with_overlong_flag(table: DataFrame, layout: Layout) -> DataFrame:
    """Replace the malformed text by a flag for rows with more fields than the header; those lose the extra ones.

    The flag mentions every field: with some of them pruned away the CSV reader would no longer
    notice that a row has too many.
    """
    whole_row = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in layout.header])) >= 0
    overlong = F.coalesce((_fields_in(F.col(BROKEN), layout.separator) > len(layout.header)) & whole_row, F.lit(False))
    return table.withColumn("overlong", overlong).drop(BROKEN)


def rows_with_open_quotes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """source_file, n: lines with an odd number of quotes, per file that has any."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias(SOURCE_FILE))
    return lines.where(quotes % 2 == 1).groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("n"))


def read_delimited(spark: SparkSession, paths: str | list[str], separator: str | None = None, multiline: bool | None = None) -> DataFrame:
    """Files as one table of text columns, null sentinels nulled.

    Every file is read by its own header: files of one layout share a scan, and layouts are united by column name,
    absent columns null. A file that can't be read stops the run.
    """
    wanted = [f for path in ([paths] if isinstance(paths, str) else paths) for f in files_below(spark, path)]
    groups, failed = layouts_of(spark, wanted, separator)
    if failed or not groups:
        raise LoadError("; ".join(f"{p}: {why}" for p, why in sorted(failed.items())) or f"no files in {paths}")
    tables = [read_layout(spark, members, layout, multiline).select(*[F.col(f"`{c}`") for c in layout.header]) for layout, members in groups.items()]
    return null_sentinels(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables))


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Delimited files of a folder by name, empty ones included. Only the listing is read."""
    listed = spark.read.format("binaryFile").load(folder).inputFiles()
    return sorted(path for path in map(unquote, listed) if path.lower().endswith(SUFFIXES))


def read_folder(spark: SparkSession, folder: str, multiline: bool | None = None) -> Batch:
    """Every file of a folder. Files of the same layout share one scan; an unreadable file is recorded
    and does not stop the others. Each table carries source_file and overlong."""
    paths = list_files(spark, folder)
    groups, failed = layouts_of(spark, paths)
    batch = Batch(failed={_name(p): why for p, why in failed.items()}, found=len(paths))
    for layout, members in groups.items():
        table = with_overlong_flag(read_layout(spark, members, layout, multiline), layout)
        batch.tables[layout] = null_sentinels(table, [SOURCE_FILE])
        batch.files[layout] = [_name(p) for p in members]
    return batch


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]
