"""Reading, cleaning, profiling, checking and writing of small messy files."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import cleaning as cl
from kpiloom.operators import intake_checks as ic
from kpiloom.operators import profiling as pr
from kpiloom.plans.intake import export, export_folder, prepare, run_folder
from kpiloom.plans.registry import ColumnRule, ConfigError, IntakeConfig
from kpiloom.sources import delimited as dl
from kpiloom.sources import sinks as sk

SITES = """Site Name, Transaction Date ,Capacity (kW),Revenue
 Alpha ,01/05/2024,4.5 MW,"$1,250"
Beta,5-Feb-24,15kW,(200)
Beta,5-Feb-24,15kW,(200)
Gamma,"March 3, 2024",N/A,33%
"""


@pytest.fixture
def sites(spark, text_file):
    return cl.clean(dl.read_delimited(spark, text_file("sites.csv", SITES)))


def test_clean_everything(sites):
    rows = sorted(tuple(r) for r in sites.table.collect())
    assert rows == [("Alpha", dt.date(2024, 1, 5), 4500, 1250), ("Beta", dt.date(2024, 2, 5), 15, -200), ("Gamma", dt.date(2024, 3, 3), None, 33)]
    assert sites.table.dtypes == [("site_name", "string"), ("transaction_date", "date"), ("capacity_kw", "bigint"), ("revenue", "bigint")]
    assert cl.clean(sites.table).table.count() == 3


def test_profile(sites):
    rows = {r.column: r for r in pr.column_profile(sites).collect()}
    assert [rows[c].semantic_type for c in ("site_name", "transaction_date", "capacity_kw", "revenue")] == ["text", "date", "power_kw", "currency"]
    assert rows["capacity_kw"].null_count == 1 and rows["revenue"].number_from_text and rows["transaction_date"].date_from_text
    counts = pr.row_counts(sites).first()
    assert (counts.rows_loaded, counts.rows_output, counts.duplicates_removed, counts.columns) == (4, 3, 1, 4)
    report = pr.profile_report(sites).first()
    assert report.null_counts["capacity_kw"] == 1 and report.numeric_columns_normalized == ["capacity_kw", "revenue"]
    assert report.columns_renamed["Site Name"] == "site_name" and report.rows_output == 3


def kinds(spark, cells):
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    return cl.infer_kinds(df)[0]["c"]


def test_column_kinds(spark):
    assert kinds(spark, ["2024-01-01", "1/2/2024", None]) == "date"
    assert kinds(spark, ["2024-01-01", "TBD"]) == "iso_text"
    assert kinds(spark, ["2024-01-01", "TBD", "soon"]) == "text"
    assert kinds(spark, ["1", "2"]) == "bigint" and kinds(spark, ["1", "2.5"]) == "double"
    assert kinds(spark, [None, None]) == "text" and kinds(spark, ["1", "x"]) == "text"


def test_mixed_dates_keep_bad_values(spark):
    df = spark.createDataFrame([("1/15/2024",), ("TBD",), ("5-Mar-2024",)], "start string")
    assert sorted(r.start for r in cl.clean(df).table.collect()) == ["2024-01-15", "2024-03-05", "TBD"]


def test_clashing_headers_are_refused(spark):
    with pytest.raises(ConfigError):
        cl.clean_headers(["A b", "a-b"])


def test_rename_and_select(sites):
    renamed = cl.rename_by_rule(sites.table, {"Site Name": ColumnRule(rename="site"), "revenue": ColumnRule(rename="usd"), "none": ColumnRule(rename="x")})
    assert renamed.columns == ["site", "transaction_date", "capacity_kw", "usd"]
    assert cl.select_output(renamed, ["usd", "nope", "site"]).columns == ["usd", "site"]
    assert cl.select_output(renamed, ["nope"]).columns == renamed.columns


@pytest.mark.parametrize("lines, want", [
    (["a,b,c", "1,2,3"], ","), (["a;b;c", "1;2;3", "4;5;6"], ";"), (["a\tb", "1\t2", "3\t4"], "\t"), (["a|b|c", "1|2|3"], "|"), (["word", "other"], ","), ([], ","),
])
def test_separator(lines, want):
    assert dl.detect_separator(lines) == want


def test_reader_byte_order_mark_bad_bytes_and_line_breaks(spark, text_file):
    path = text_file("odd.csv", b'\xef\xbb\xbfname,note\nA,"two\nlines"\nB,caf\xe9\nC,NULL\n')
    rows = {r.name: r.note for r in dl.read_delimited(spark, path, multiline=True).collect()}
    assert rows == {"A": "two\nlines", "B": "caf�", "C": None}


def test_files_with_open_quotes_are_named(spark, text_file):
    paths = [text_file("open.csv", 'a,b\n1,"x\ny"\n'), text_file("plain.csv", 'a,b\n1,"5 ""pipe"""\n')]
    assert [tuple(r) for r in dl.rows_with_open_quotes(spark, paths).collect()] == [("open.csv", 2)]


def test_each_file_is_read_by_its_own_header(spark, text_file):
    paths = [text_file("one.csv", "id,name\n1,x\n"), text_file("two.csv", "name;id\ny;2\n"), text_file("three.csv", "id,extra\n3,z\n"), text_file("four.csv", "id,name\n")]
    rows = dl.read_delimited(spark, paths).select("id", "name", "extra").collect()
    assert sorted(map(tuple, rows)) == [("1", "x", None), ("2", "y", None), ("3", None, "z")]
    with pytest.raises(dl.LoadError):
        dl.read_delimited(spark, [*paths, text_file("none.csv", "")])


def test_overlong_rows_lose_the_extra_fields(spark, text_file, tmp_path):
    text_file("long.csv", "a,b\n1,2\n3,4,5\n6\n\"x,y\",7\n")
    table = dl.read_folder(spark, str(tmp_path)).union()
    rows = {(r.a, r.b): r.overlong for r in table.collect()}
    assert rows == {("1", "2"): False, ("3", "4"): True, ("6", None): False, ("x,y", "7"): False}


def test_folder_run(spark, text_file, tmp_path):
    text_file("one.csv", "Id,Amount\n1,$5\n1,$5\n2,$7\n")
    text_file("two.csv", "Id,Amount\n3,$9\n4,$1,000\n")
    text_file("three.tsv", "Id\tAmount\tNote\n5\t$2\tx\n")
    text_file("empty.csv", "")
    text_file("ignored.txt", "nothing")
    run = run_folder(spark, str(tmp_path), IntakeConfig(required_columns=["id", "note"], block_export_on_fail=True))
    totals = run.totals.first()
    assert (totals.files_found, totals.files_processed, totals.files_failed) == (4, 3, 1)
    assert (totals.rows_loaded_total, totals.rows_output_total, totals.duplicates_removed_total) == (6, 5, 1)
    assert (totals.warnings_total, totals.files_failed_validation, totals.files_export_blocked) == (1, 2, 2)
    statuses = {r.source_file: r.status for r in run.files.collect()}
    assert statuses == {"one.csv": "fail", "two.csv": "fail", "three.tsv": "pass"}


def test_files_without_rows_are_found_empty(spark, text_file, tmp_path):
    text_file("full.csv", "Id,Amount\n1,$5\n2,$6\n")
    text_file("bare.csv", "Id,Amount\n")
    text_file("other.csv", "Amount,Id,Note\n$7,3,n\n")
    config = IntakeConfig(block_export_on_fail=True)
    run = run_folder(spark, str(tmp_path), config)
    totals = run.totals.first()
    assert (totals.files_found, totals.files_processed, totals.files_failed_validation, totals.rows_loaded_total) == (3, 3, 1, 3)
    assert {r.source_file: (r.status, r.rows_loaded) for r in run.files.collect()} == {"full.csv": ("pass", 2), "bare.csv": ("fail", 0), "other.csv": ("pass", 1)}
    assert [(r.source_file, r.message) for r in run.findings.where("check = 'empty'").collect()] == [("bare.csv", "empty file: 0 rows loaded")]
    gate = {r.source_file: r.exported for r in export_folder(run, str(tmp_path / "out"), config).collect()}
    assert gate == {"full.csv": True, "bare.csv": False, "other.csv": True}
    written = spark.read.option("header", True).csv([str(p) for p in (tmp_path / "out").glob("layout-*/source_file=full.csv")])
    assert sorted(map(tuple, written.select("id", "amount").collect())) == [("1", "5"), ("2", "6")]


def test_folder_without_a_readable_file(spark, text_file, tmp_path):
    text_file("empty.csv", "")
    run = run_folder(spark, str(tmp_path), IntakeConfig())
    totals = run.totals.first()
    assert (totals.files_found, totals.files_processed, totals.files_failed) == (1, 0, 1) and run.files.count() == 0


def test_validation_ladder(spark, sites):
    def status(**options):
        found = ic.validate(sites, **options)
        return ic.fnd.counts_of(found).select(ic.fnd.status_of(ic.STATUSES).alias("s")).first().s

    assert status(null_threshold=0.5) == "pass"
    assert status(null_threshold=0.3) == "warn"
    assert status(required=["lease"]) == "fail"
    assert status(null_threshold=0.5, required=["Site Name"]) == "warn"
    assert status(null_threshold=0.5, rules={"capacity_kw": ColumnRule(nullable=False)}) == "warn"
    assert status(null_threshold=0.5, rules={"revenue": ColumnRule(type="date")}) == "warn"


def test_empty_input_is_an_issue(spark):
    empty = spark.createDataFrame([], "a string")
    assert [r.check for r in ic.data_findings(empty).collect()] == ["empty"]


def test_duplicate_rate_needs_two(spark):
    def checks(rows):
        return [r.check for r in ic.data_findings(spark.createDataFrame([(r,) for r in rows], "a string")).collect()]

    assert checks(["x", "x"]) == [] and checks(["x", "x", "x"]) == ["duplicate_rate"]


def test_gate_blocks_export(spark, text_file, tmp_path):
    raw = dl.read_delimited(spark, text_file("g.csv", SITES))
    blocked = prepare(raw, IntakeConfig(required_columns=["lease"], block_export_on_fail=True))
    assert not export(blocked, str(tmp_path / "out"), IntakeConfig(block_export_on_fail=True))
    assert not (tmp_path / "out").exists()
    config = IntakeConfig(output_format="parquet", select_columns=["revenue", "site_name"])
    assert export(prepare(raw, config), str(tmp_path / "out"), config)
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["revenue", "site_name"]


def test_append_twice_is_append_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    second = spark.createDataFrame([(2, None), (3, "c"), (3, "c")], "k int, v string")
    assert sk.load_table(first, path, "append") == 2
    assert sk.load_table(second, path, "append") == 3
    assert sk.load_table(second, path, "append") == 3
    assert sk.load_table(second, path, "replace") == 3
    with pytest.raises(ValueError):
        sk.load_table(second, path, "merge")
    assert sk.table_name("my file-1") == "my_file_1_clean"


def test_append_takes_the_stored_types_or_stops(spark, tmp_path):
    path = str(tmp_path / "t")
    sk.load_table(spark.createDataFrame([(1, "a")], "k bigint, v string"), path, "append")
    assert sk.load_table(spark.createDataFrame([(2.0, "b")], "k double, v string"), path, "append") == 2
    for bad in (spark.createDataFrame([(2.5, "b")], "k double, v string"), spark.createDataFrame([(3, "c", 1)], "k bigint, v string, extra int"), spark.createDataFrame([(3,)], "k bigint")):
        with pytest.raises(ValueError):
            sk.load_table(bad, path, "append")
    assert sorted(map(tuple, sk.read_table(spark, path).collect())) == [(1, "a"), (2, "b")]


def test_csv_sink_keeps_spaces_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", ok', " pad ")], "a string, b string")
    path = sk.write_csv(df, str(tmp_path / "c"))
    assert tuple(dl.read_delimited(spark, path).first()) == ('say "hi", ok', " pad ")


def test_keep_column_limits_duplicates_to_a_file(spark):
    df = spark.createDataFrame([("1", "f1"), ("1", "f1"), ("1", "f2")], "Id string, source_file string")
    done = cl.clean(df, ["source_file"])
    assert done.table.count() == 2 and done.kinds == {"id": "bigint"}
    assert done.table.filter(F.col("source_file") == "f1").count() == 1


def test_stripping_numbers_stays_within_what_the_jvm_compiles(spark, tmp_path, capsys):
    rows = [("($1,250.50)", " 7 ", "33%"), ("(200)", "€ 4,000", None), ("( 1,0 )x", "%", "a, b"), ("$ 5", "(3,)", "1,2,3%%"), ("(1) 2", "£1,000", "")]
    columns = ["a", "b", "c", *[f"x{i}" for i in range(5)]]
    spark.createDataFrame([(*r, *r, *r[:2]) for r in rows], ", ".join(f"{c} string" for c in columns)).write.parquet(f"{tmp_path}/cells")
    bare = cl.plain_numbers(spark.read.parquet(f"{tmp_path}/cells"), ["x4"])
    assert bare.columns == columns
    found = {tuple(r)[:3] for r in bare.collect()}
    assert found == {("($1250.50)", " 7 ", "33"), ("-200", "4000", None), ("( 10 )x", None, "a, b"), ("5", "-3,", "123%"), ("(1) 2", "1000", None)}
    assert {r.x4 for r in bare.collect()} == {" 7 ", "€ 4,000", "%", "(3,)", "£1,000"}
    bare.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert max(sizes) <= 8000
