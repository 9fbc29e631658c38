"""Versioned tables: replacing, appending new rows, failures half-way."""

import pytest
from pyspark.sql import functions as F

from kpiloom.sources import sinks as sk
from kpiloom.sources import versions as vs


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.fixture
def tables(spark, tmp_path):
    return vs.VersionedTables(spark, str(tmp_path / "db"))


def failing(spark):
    bad = F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("long"))
    return spark.range(0, 1000, 1, 4).select(bad.alias("id"))


def test_a_table_may_be_replaced_from_itself(spark, tables):
    tables.replace({"t": spark.range(10)})
    before = tables.read("t")
    tables.replace({"t": tables.read("t").where("id > 3")})
    assert tables.read("t").count() == 6 and before.count() == 10 and tables.read("t", version=1).count() == 10
    assert [v.number for v in tables.versions()] == [1, 2]


@pytest.mark.parametrize("keyed", [False, True])
def test_a_write_that_fails_leaves_the_version_before(spark, tables, keyed):
    tables.replace({"t": spark.range(5), "u": spark.range(2)}, keyed=keyed)
    with pytest.raises(Exception, match="half-way"):
        tables.replace({"u": spark.range(7), "t": failing(spark)}, keyed=keyed)
    with pytest.raises(Exception, match="half-way"):
        tables.append_new("t", failing(spark))
    assert (tables.current().number, tables.read("t").count(), tables.read("u").count()) == (1, 5, 2)
    tables.append_new("t", spark.range(3, 8))
    assert rows_of(tables.read("t")) == sorted(str((i,)) for i in range(8))


def test_tables_change_together_and_others_stay(spark, tables):
    tables.replace({"a": spark.range(1), "b": spark.range(2)})
    version = tables.replace({"b": spark.range(3).withColumn("p", F.concat(F.lit("0"), "id"))}, {"b": ["p"]})
    assert version.number == 2 and tables.read("a").count() == 1
    assert rows_of(tables.read("b")) == sorted(str((i, f"0{i}")) for i in range(3)) and tables.read("b", 1).columns == ["id"]
    with pytest.raises(KeyError):
        tables.read("c")


def test_a_second_writer_of_a_version_is_refused(spark, tables):
    tables.replace({"t": spark.range(1)})
    before = vs.Version(0, {})
    with pytest.raises(Exception, match="(?i)exists"):
        tables._commit(before, {})
    assert tables.read("t").count() == 1


def test_old_versions_are_deleted_with_what_only_they_hold(spark, tables):
    tables.append_new("t", spark.range(3))
    tables.append_new("t", spark.range(5))
    tables.replace({"u": spark.range(4)})
    tables.replace({"u": spark.range(2)})
    assert tables.forget(keep=1) == [1, 2, 3]
    assert tables.read("t").count() == 5 and tables.read("u").count() == 2 and [v.number for v in tables.versions()] == [4]
    assert spark.read.parquet(f"{tables.folder}/data/u").count() == 2


ODD = "k int, v string, d double, a array<string>, dt date"


def odd_rows(spark):
    nan = float("nan")
    return spark.createDataFrame([(1, None, 0.0, ["x"], None), (None, "1", nan, None, None), (1, None, 0.0, ["x"], None), (None, "1", None, [None], None), (None, None, None, [], None)], ODD)


def test_append_takes_distinct_new_rows_with_nulls_equal(spark, tables):
    first = odd_rows(spark)
    tables.append_new("t", first)
    assert rows_of(tables.read("t")) == rows_of(first) and tables.count("t") == 5
    more = odd_rows(spark).union(spark.createDataFrame([(1, "", -0.0, ["x"], None), (1, "", 0.0, ["x"], None)], ODD))
    for _ in range(2):
        tables.append_new("t", more.union(more))
    assert tables.count("t") == 6 and tables.read("t").where("v = ''").count() == 1
    assert tables.rows_not_in("t", more).count() == 0


def test_equal_digests_are_settled_on_the_row(spark, tables, monkeypatch):
    narrow = lambda columns: [F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(3)).alias(d) for d in vs.DIGEST]
    monkeypatch.setattr(vs, "digests", narrow)
    tables.append_new("t", spark.range(40).withColumn("b.c", F.col("id") % 3))
    tables.append_new("t", spark.range(20, 60).withColumn("b.c", F.col("id") % 3))
    assert rows_of(tables.read("t")) == sorted(str((i, i % 3)) for i in range(60))


def test_the_stored_side_of_an_append_is_not_shuffled(spark, tables):
    tables.append_new("t", spark.range(100).withColumn("s", F.col("id").cast("string")))
    tables.append_new("t", spark.range(50, 120).withColumn("s", F.col("id").cast("string")))
    stored = tables.current().tables["t"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with tables._known("t", stored) as known:
            plan = tables._unknown(spark.range(90, 130).withColumn("s", F.col("id").cast("string")), known, ["id", "s"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan[plan.index("SortMergeJoin") :].split("\n")
    # the stored side is the join's last child: its lines follow the last one that hangs on the join itself
    depth = min(line.index("+- ") for line in lines[1:] if "+- " in line)
    stored_side = lines[max(i for i, line in enumerate(lines) if line[depth:].startswith("+- ")) :]
    assert "LeftAnti" in lines[0] and any("FileScan" in line and "Bucketed: true" in line for line in stored_side)
    assert not any("Exchange" in line for line in stored_side) and any("Exchange" in line for line in lines)


def test_a_table_stored_without_digests_is_appended_to(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sk.load_table(spark.range(3).union(spark.range(2)), path, "replace") == 5
    assert sk.load_table(spark.range(5), path, "append") == 7
    assert sk.load_table(sk.read_table(spark, path).where("id = 1"), path, "replace") == 2
    assert rows_of(sk.read_table(spark, path)) == ["(1,)", "(1,)"] and rows_of(sk.read_table(spark, path, 1)) == sorted(["(0,)", "(1,)", "(2,)", "(0,)", "(1,)"])


def test_empty_tables(spark, tables):
    tables.append_new("t", spark.range(0))
    assert tables.count("t") == 0 and tables.read("t").count() == 0
    tables.append_new("t", spark.range(2))
    tables.append_new("t", spark.range(0))
    assert tables.count("t") == 2
