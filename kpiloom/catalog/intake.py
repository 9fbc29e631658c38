"""Reading, cleaning, profiling and checking of messy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.catalog import sql as S
from kpiloom.catalog.registrar import query
from kpiloom.functions import numbers as nb
from kpiloom.functions.text import match_key
from kpiloom.operators import cleaning as cl
from kpiloom.operators import findings as fnd
from kpiloom.operators import intake_checks as ic
from kpiloom.operators import profiling as pr
from kpiloom.plans import views
from kpiloom.plans.registry import ColumnRule
from kpiloom.session import materialized

SOURCE = ["source_file"]
COLS = S.MESSY_COLUMNS
TEXT = "SELECT " + ", ".join(COLS) + " FROM "


def messy(spark, folder) -> DataFrame:
    return views.messy_orders(spark, folder)


def plain_messy(spark, folder) -> DataFrame:
    return messy(spark, folder).drop(*SOURCE)


@query("CLN1", f"WITH {S.MESSY} {TEXT} messy")
def headers_cleaned(spark, folder):
    return cl.with_clean_headers(plain_messy(spark, folder))


@query("CLN2", "SELECT o_orderkey, o_orderstatus AS o__order_status, o_totalprice AS total_price_usd FROM orders")
def headers_matched(spark, folder):
    headers = ["O.OrderKey", " O__Order Status! ", "Total/Price (USD)"]
    raw = views.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").toDF(*headers)
    return raw.toDF(*[match_key(h) for h in headers])


@query("CLN3", f"WITH {S.MESSY} SELECT {S.each(COLS, S.trimmed)} FROM messy")
def cells_trimmed(spark, folder):
    return cl.clean_cells(cl.with_clean_headers(plain_messy(spark, folder)))


@query("CLN4", f"WITH {S.MESSY}, cells AS (SELECT {S.each(COLS, S.trimmed)} FROM messy) SELECT {S.each(COLS, S.plain)} FROM cells")
def numbers_bared(spark, folder):
    return cl.plain_numbers(cl.clean_cells(cl.with_clean_headers(plain_messy(spark, folder))))


@query("CLN5", f"WITH {S.MESSY_TEXT} SELECT order_key, rack_density FROM standard")
def units_normalized(spark, folder):
    raw = cl.null_sentinels(plain_messy(spark, folder))
    return cl.standardize(raw).select("order_key", "rack_density")


@query("CLN6", f"""WITH {S.MESSY_TEXT}
SELECT order_key, {S.date_of("order_date")} AS order_date, coalesce({S.date_of("contract_start")}::VARCHAR, contract_start) AS contract_start
FROM standard""")
def dates_normalized(spark, folder):
    standard = cl.standardize(cl.null_sentinels(plain_messy(spark, folder))).select("order_key", "order_date", "contract_start")
    kinds, _ = cl.infer_kinds(standard, keep=["order_key"])
    return cl.apply_kinds(standard, kinds)


@query("CLN7", "SELECT event_id, ts::DATE AS ts, event_type FROM events")
def datetimes_dated(spark, folder):
    return cl.datetimes_to_dates(views.table(spark, folder, "events").select("event_id", "ts", "event_type"))


_COUNTED = ["order_key", "order_date", "contract_start", "total_price", "rack_density", "ship_note", "customer_id", "status_flag"]
_NUMERIC = "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"


_KINDS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS present, count({S.date_of(c)}) AS dates, "
    f"count(CASE WHEN regexp_full_match({c}, '[+-]?[0-9]+') THEN 1 END) AS whole, "
    f"count(CASE WHEN regexp_full_match({c}, {_NUMERIC}) THEN 1 END) AS numbers FROM standard" for c in _COUNTED)


@query("CLN8", f"WITH {S.MESSY_TEXT} " + _KINDS)
def kinds_counted(spark, folder):
    standard = cl.standardize(cl.null_sentinels(plain_messy(spark, folder)))
    counted = standard.agg(*[e.alias(n) for n, e in cl.kind_counts(standard).items()])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{kind}:{c}`").alias(name) for kind, name in
                 (("present", "present"), ("date", "dates"), ("bigint", "whole"), ("double", "numbers"))]) for c in standard.columns
    ])
    return counted.select(F.inline(rows))


@query("CLN9", f"WITH {S.MESSY_TYPED} SELECT DISTINCT {', '.join(COLS)} FROM typed")
def cleaned(spark, folder):
    return cl.clean(plain_messy(spark, folder)).table


RULES = {"Order Key": ColumnRule(rename="order_id", type="numeric", nullable=False), "total_price": ColumnRule(rename="amount", type="numeric"),
         "Contract Start": ColumnRule(type="date"), "Ship Note": ColumnRule(nullable=False, type="string")}


@query("CLN10", f"WITH {S.MESSY_TYPED} SELECT order_key AS order_id, order_date, contract_start, total_price AS amount, rack_density, ship_note, customer_id, status_flag FROM typed")
def renamed_by_rule(spark, folder):
    return cl.rename_by_rule(cl.clean(plain_messy(spark, folder)).typed, RULES)


@query("CLN11", f"WITH {S.MESSY_TYPED} SELECT customer_id, order_key, total_price FROM typed")
def output_selected(spark, folder):
    return cl.select_output(cl.clean(plain_messy(spark, folder)).typed, ["customer_id", "no_such_column", "order_key", "total_price"])


@query("SRC4", f"WITH {S.MESSY} SELECT {S.each(COLS, S.nulled)} FROM messy")
def sentinels_nulled(spark, folder):
    return cl.null_sentinels(cl.with_clean_headers(plain_messy(spark, folder)))


@query("SET1", f"WITH {S.MESSY} SELECT DISTINCT {', '.join(COLS)}, source_file FROM messy")
def duplicates_removed(spark, folder):
    return cl.with_clean_headers(messy(spark, folder), SOURCE).dropDuplicates()


_SIDES = """
loaded AS (SELECT source_file, count(*) AS rows_loaded FROM typed GROUP BY source_file),
kept AS (SELECT source_file, count(*) AS rows_output FROM (SELECT DISTINCT * FROM typed) GROUP BY source_file)"""


@query("PRF1", f"""WITH {S.MESSY_TYPED}, {_SIDES}
SELECT source_file, rows_loaded, rows_output, rows_loaded - rows_output AS duplicates_removed, 8 AS columns FROM loaded JOIN kept USING (source_file)""")
def rows_counted(spark, folder):
    return pr.row_counts(cl.clean(messy(spark, folder), SOURCE), SOURCE)


_DISTINCT_TYPED = f"{S.MESSY_TYPED}, d AS (SELECT DISTINCT * FROM typed)"


@query("PRF2", f"WITH {_DISTINCT_TYPED} " + " UNION ALL ".join(
    f"SELECT source_file, '{c}' AS \"column\", count(*) - count({c}) AS null_count FROM d GROUP BY source_file" for c in COLS))
def nulls_counted(spark, folder):
    return pr.column_profile(cl.clean(messy(spark, folder), SOURCE), SOURCE).select("source_file", "column", "null_count")


#: What the counts of a column's values make of it.
_TYPED_AS = "CASE WHEN dates = present AND present > 0 THEN 'Date' WHEN dates >= 0.5 * present THEN 'String' WHEN whole = present THEN 'Int64' WHEN numbers = present THEN 'Float64' ELSE 'String' END"


@query("PRF3", f"WITH {S.MESSY_TEXT}, kinds AS ({_KINDS}) SELECT column_name AS \"column\", {_TYPED_AS} AS inferred_type FROM kinds")
def types_inferred(spark, folder):
    return pr.column_profile(cl.clean(plain_messy(spark, folder))).select("column", "inferred_type")


_RENAMED = {" Order Key ": "order_key", "Order-Date": "order_date", "Contract Start": "contract_start", "Total Price ($)": "total_price",
            "Rack Density": "rack_density", "Ship Note": "ship_note", "Customer ID": "customer_id", "Status/Flag": "status_flag"}


@query("PRF4", f"WITH {S.MESSY} " + " UNION ALL ".join(
    f"SELECT '{old}' AS old_name, '{new}' AS new_name, count({new}) AS n_values FROM messy" for old, new in _RENAMED.items()))
def headers_mapped(spark, folder):
    raw = plain_messy(spark, folder)
    names = cl.clean_headers(raw.columns)
    counted = raw.agg(*[F.count(F.col(f"`{old}`")).alias(new) for old, new in names.items() if old != new])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(old).alias("old_name"), F.lit(new).alias("new_name"), F.col(new).alias("n_values"))
        for old, new in names.items() if old != new
    ])))


_PLAIN = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS given, count(CASE WHEN regexp_full_match({c}, {_NUMERIC}) THEN 1 END) AS bare FROM sourced" for c in _COUNTED)


@query("PRF5", f"""WITH {S.MESSY_TEXT}, kinds AS ({_KINDS}), plain AS ({_PLAIN})
SELECT column_name AS "column" FROM kinds JOIN plain USING (column_name) WHERE {_TYPED_AS} IN ('Int64', 'Float64') AND bare < given""")
def numbers_from_text(spark, folder):
    return pr.column_profile(cl.clean(plain_messy(spark, folder))).filter("number_from_text").select("column")


_ISO_TEXT = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_UNIFORM = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (SELECT count({c}) > 0 AND count({c}) = count(CASE WHEN regexp_full_match({c}, '{_ISO_TEXT}') THEN 1 END) FROM sourced) AS before, "
    f"(SELECT count({c}) > 0 AND count({c}) = count(CASE WHEN regexp_full_match({c}::VARCHAR, '{_ISO_TEXT}') THEN 1 END) FROM typed) AS after" for c in _COUNTED)


@query("PRF6", f"""WITH {S.MESSY_TYPED}, kinds AS ({_KINDS}), uniform AS ({_UNIFORM})
SELECT column_name AS "column" FROM kinds JOIN uniform USING (column_name) WHERE {_TYPED_AS} = 'Date' OR ({_TYPED_AS} = 'String' AND after AND NOT before)""")
def dates_from_text(spark, folder):
    return pr.column_profile(cl.clean(plain_messy(spark, folder))).filter("date_from_text").select("column")


def _semantic_sql(c: str) -> str:
    by_name = {"order_key": "'numeric'", "order_date": "'date'", "total_price": "'currency'", "rack_density": "'power_kw'"}.get(c)
    if by_name is None:
        iso = f"count(CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 1 END)"
        ident = "'identifier'" if c == "customer_id" else "'text'"
        mostly = f"({iso} >= 0.7 * count({c}) OR ({iso} >= 3 AND {iso} > count({c}) / 2.0))"
        by_name = (f"CASE WHEN count({c}) = 0 THEN 'text' WHEN {mostly} AND {iso} = count({c}) THEN 'date' "
                   f"WHEN {mostly} THEN 'date_mixed_invalid' ELSE {ident} END")
    return f"SELECT source_file, '{c}' AS \"column\", {by_name} AS semantic_type FROM d GROUP BY source_file"


@query("PRF7", f"WITH {_DISTINCT_TYPED} " + " UNION ALL ".join(_semantic_sql(c) for c in COLS))
def meanings_inferred(spark, folder):
    return pr.column_profile(cl.clean(messy(spark, folder), SOURCE), SOURCE).select("source_file", "column", "semantic_type")


def _typed(spark, folder) -> DataFrame:
    return cl.clean(messy(spark, folder), SOURCE).typed


def _found(spark, folder, **options) -> DataFrame:
    return ic.data_findings(_typed(spark, folder), SOURCE, **options)


@query("VAL1", f"""WITH {S.MESSY}, t AS (SELECT *, 1 AS part FROM messy), n AS (SELECT count(*) AS n FROM messy WHERE status_flag = 'no such flag')
SELECT 'empty' AS "check", 'error' AS severity, NULL::VARCHAR AS "column", 1::BIGINT AS n, 'empty file: 0 rows loaded' AS message FROM n WHERE n.n = 0""")
def empty_input(spark, folder):
    nothing = cl.with_clean_headers(plain_messy(spark, folder)).filter(F.col("status_flag") == "no such flag")
    return ic.data_findings(nothing).filter(F.col("check").isin("empty", "nothing_left"))


@query("VAL2", f"""WITH {S.MESSY} SELECT 'single_column' AS "check", 'warning' AS severity, source_file FROM messy GROUP BY source_file""")
def single_column(spark, folder):
    one = messy(spark, folder).select("Customer ID", *SOURCE)
    files = one.groupBy(*SOURCE).count()
    names = ic.name_findings(["Customer ID"], ["customer_id"], [])
    return fnd.known_for_each(files, SOURCE, names).select("check", "severity", *SOURCE)


@query("VAL3", f"""WITH {S.MESSY}, files AS (SELECT DISTINCT source_file FROM messy)
SELECT source_file, 'required_missing' AS "check", 'error' AS severity, 'lease_end' AS "column", 'required column missing: ''lease_end''' AS message FROM files
UNION ALL SELECT source_file, 'required_renamed', 'warning', 'Order-Date',
'required column ''Order-Date'' was renamed to ''order_date'' during cleaning — update required_columns to use ''order_date''' FROM files""")
def required_columns(spark, folder):
    raw = messy(spark, folder)
    names = cl.clean_headers([c for c in raw.columns if c not in SOURCE])
    found = ic.name_findings(list(names), list(names.values()), ["order_key", "Order-Date", "lease_end"])
    return fnd.known_for_each(raw.groupBy(*SOURCE).count(), SOURCE, found).select(*SOURCE, "check", "severity", "column", "message")


@query("VAL4", f"""WITH {S.MESSY_TYPED}, {_SIDES}, r AS (SELECT *, (rows_loaded - rows_output) / rows_loaded::DOUBLE AS rate FROM loaded JOIN kept USING (source_file))
SELECT source_file, 'duplicate_rate' AS "check", rows_loaded - rows_output AS n,
  'high duplicate rate: ' || format('{{:.1f}}', rate * 100) || '% of rows are duplicates' AS message
FROM r WHERE rate > 0.3 AND rows_loaded - rows_output >= 2""")
def duplicate_rates(spark, folder):
    return _found(spark, folder).filter(F.col("check") == "duplicate_rate").select("source_file", "check", "n", "message")


@query("VAL5", f"WITH {_DISTINCT_TYPED} " + " UNION ALL ".join(
    f"SELECT source_file, '{c}' AS \"column\", round_even((count(*) - count({c}))::DOUBLE / count(*), 4) AS null_rate FROM d GROUP BY source_file" for c in COLS))
def null_shares(spark, folder):
    return ic.null_rates(ic.table_counts(_typed(spark, folder), SOURCE), COLS, SOURCE)


@query("VAL6", f"""WITH {_DISTINCT_TYPED}, c AS (SELECT source_file, count(contract_start) AS present,
  count(CASE WHEN regexp_matches(contract_start, '\\b\\d{{1,4}}[/\\-]\\d{{1,2}}[/\\-]\\d{{1,4}}\\b') THEN 1 END) AS like_date,
  count(CASE WHEN regexp_full_match(contract_start, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 1 END) AS iso FROM d GROUP BY source_file)
SELECT source_file, 'mixed_dates' AS "check", 'contract_start' AS "column", present - iso AS n,
  'date-like column ''contract_start'': mixed valid/invalid date values remain after cleaning' AS message
FROM c WHERE present > 0 AND like_date / present >= 0.2 AND iso < present""")
def leftover_dates(spark, folder):
    return _found(spark, folder).filter(F.col("check") == "mixed_dates").select("source_file", "check", "column", "n", "message")


@query("VAL7", f"""WITH {_DISTINCT_TYPED}, c AS (SELECT source_file, count(*) - count(ship_note) AS n FROM d GROUP BY source_file)
SELECT source_file, 'not_nullable' AS "check", 'ship_note' AS "column", n, 'column ''ship_note'' has ' || n || ' null(s) but is configured as nullable: false' AS message FROM c WHERE n > 0
UNION ALL SELECT source_file, 'wrong_type', 'contract_start', 1, 'column ''contract_start'': expected type ''date'' but got ''String''' FROM c""")
def column_rules(spark, folder):
    table = cl.rename_by_rule(_typed(spark, folder), RULES)
    found = ic.data_findings(table, SOURCE, rules=RULES)
    return found.filter(F.col("check").isin("not_nullable", "wrong_type")).select("source_file", "check", "column", "n", "message")


_NULLS = " + ".join(f"((count(*) - count({c})) / count(*)::DOUBLE > 0.3)::BIGINT" for c in COLS)
_STATUS_CTES = f"""{_DISTINCT_TYPED}, {_SIDES},
w AS (SELECT source_file, {_NULLS} AS null_warnings,
  (count(CASE WHEN regexp_full_match(contract_start, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 1 END) BETWEEN 0.2 * count(contract_start) AND count(contract_start) - 1)::BIGINT AS date_warnings
  FROM d GROUP BY source_file),
e AS (SELECT source_file, CASE WHEN source_file = 'batch_5.csv' THEN 1 ELSE 0 END::BIGINT AS error_count FROM w),
s AS (SELECT source_file, rows_loaded, rows_output, error_count,
  null_warnings + date_warnings + ((rows_loaded - rows_output) / rows_loaded::DOUBLE > 0.3 AND rows_loaded - rows_output >= 2)::BIGINT AS warning_count
  FROM w JOIN loaded USING (source_file) JOIN kept USING (source_file) JOIN e USING (source_file)),
t AS (SELECT *, CASE WHEN error_count > 0 THEN 'fail' WHEN warning_count > 0 THEN 'warn' ELSE 'pass' END AS status FROM s)"""


def _statuses(spark, folder) -> DataFrame:
    """Per-file statuses; the last batch is one where a required column is missing."""
    typed = _typed(spark, folder)
    counts = materialized(ic.table_counts(typed, SOURCE), "file-counts")  # one row per file, read by files, late files and findings
    files = counts.select(*SOURCE, "rows_loaded", "rows_output").withColumn("load_warnings", F.lit(0).cast("bigint"))
    late = files.filter(F.col("source_file") == "batch_5.csv")
    missing = fnd.known_for_each(late, SOURCE, ic.name_findings(["a", "b"], COLS, ["lease_end"]))
    return ic.file_statuses(files, ic.data_findings(typed, SOURCE, counts=counts).unionByName(missing), SOURCE).select(
        *SOURCE, "rows_loaded", "rows_output", "error_count", "warning_count", "status", "load_warnings")


@query("VAL8", f"WITH {_STATUS_CTES} SELECT source_file, rows_loaded, rows_output, error_count, warning_count, status FROM t")
def statuses(spark, folder):
    return _statuses(spark, folder).drop("load_warnings")


@query("VAL9", f"WITH {_STATUS_CTES} SELECT {', '.join(COLS)}, source_file FROM d WHERE source_file IN (SELECT source_file FROM t WHERE status <> 'fail')")
def gated(spark, folder):
    passed = _statuses(spark, folder).filter(F.col("status") != "fail")
    return cl.clean(messy(spark, folder), SOURCE).table.join(passed.select(*SOURCE), SOURCE, "left_semi")


@query("VAL10", f"""WITH {_STATUS_CTES} SELECT count(*) + 1 AS files_found, count(*) AS files_processed, 1::BIGINT AS files_failed,
  sum(rows_loaded)::BIGINT AS rows_loaded_total, sum(rows_output)::BIGINT AS rows_output_total,
  sum(rows_loaded - rows_output)::BIGINT AS duplicates_removed_total, 0::BIGINT AS warnings_total,
  count(*) FILTER (status = 'fail') AS files_failed_validation, count(*) FILTER (status = 'fail') AS files_export_blocked FROM t""")
def totals(spark, folder):
    return ic.batch_totals(_statuses(spark, folder), True, {"broken.csv": "no lines"})


@query("VAL11", f"WITH {_STATUS_CTES} SELECT CASE WHEN bool_or(status = 'fail') THEN 'fail' WHEN bool_or(status = 'warn') THEN 'warn' ELSE 'pass' END AS status FROM t")
def worst(spark, folder):
    return ic.worst_status(_statuses(spark, folder))


@query("FMT5", f"WITH {_DISTINCT_TYPED}, r AS (" + " UNION ALL ".join(
    f"SELECT source_file, '{c}' AS \"column\", round_even((count(*) - count({c}))::DOUBLE / count(*), 4) AS null_rate FROM d GROUP BY source_file" for c in COLS)
    + ") SELECT *, CASE WHEN round_even(null_rate * 100, 1) > 30 THEN 'hi' WHEN round_even(null_rate * 100, 1) > 5 THEN 'mid' ELSE 'ok' END AS band FROM r")
def null_bands(spark, folder):
    rates = ic.null_rates(ic.table_counts(_typed(spark, folder), SOURCE), COLS, SOURCE)
    return rates.withColumn("band", nb.null_rate_band(F.col("null_rate")))
