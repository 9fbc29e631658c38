"""SQL statements of the working views and of the metric tables, for the expected results.

Written independently of the DataFrame code: rollups as separate GROUP BY queries, melting as UNION
ALL, dates through the engine's own format parser.
"""

from __future__ import annotations

REQUIREMENTS = """
req AS (
  SELECT date_trunc('month', o_orderdate)::DATE AS date, o_custkey AS project_id, n_name AS portfolio,
    CASE WHEN o_custkey % 97 = 0 THEN NULL
         ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'power' WHEN 'BUILDING' THEN 'site_control'
              WHEN 'FURNITURE' THEN 'commercial' WHEN 'HOUSEHOLD' THEN 'capital' WHEN 'MACHINERY' THEN 'permitting' END END AS category,
    r_name AS market,
    CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'P' THEN 'in_progress' ELSE 'open' END AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' ELSE 'medium' END AS severity
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

FACTS = """
facts AS (
  SELECT date_trunc('month', o_orderdate)::DATE AS date,
    (l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(12,2)))::DECIMAL(18,4) AS revenue,
    l_quantity::DECIMAL(12,2) AS capacity_mw,
    (l_quantity::DECIMAL(12,2) * (1 - l_tax::DECIMAL(12,2)))::DECIMAL(18,4) AS leased_mw,
    l_extendedprice::DECIMAL(12,2) AS contracted_kw,
    CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE r_name END AS region, c_mktsegment AS provider
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

SALES = """
sales AS (
  SELECT l_orderkey AS order_id, o_orderdate::DATE AS order_date, l_shipdate::DATE AS ship_date, l_returnflag AS ship_mode,
    o_custkey AS customer_id, l_partkey AS product_id, l_quantity::INTEGER AS quantity,
    (l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(12,2)))::DECIMAL(10,2) AS sales,
    l_discount::DECIMAL(5,2) AS discount,
    (l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(12,2)) - l_extendedprice::DECIMAL(12,2) * 0.6::DECIMAL(2,1))::DECIMAL(10,2) AS profit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category FROM part),
customers AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS segment, r_name AS region, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

SALES_RAW = SALES + """,
raw AS (
  SELECT order_id::VARCHAR AS order_id, strftime(order_date, '%m/%d/%Y') AS order_date, strftime(ship_date, '%m/%d/%Y') AS ship_date,
    ship_mode, customer_id::VARCHAR AS customer_id, product_id::VARCHAR AS product_id, quantity::VARCHAR AS quantity,
    sales::DECIMAL(12,4)::VARCHAR AS sales, discount::VARCHAR AS discount, profit::VARCHAR AS profit,
    segment, region, country, product_name, category, sub_category
  FROM sales JOIN customers USING (customer_id) JOIN products USING (product_id)
)"""


def money(expr: str) -> str:
    """Two decimals of a quotient of amounts in cents, half away from zero; the doubles miss a half by far less than 1e-9."""
    return f"round({expr} + sign({expr}) * 1e-9, 2)"


def cents(expr: str) -> str:
    return f"round({expr}, 2)::DOUBLE"


READINESS = [
    ("total_requirement_count", "Total Requirement Count", "requirements", 0, "count(*)::DOUBLE"),
    ("open_gap_count", "Open Gap Count", "gaps", 0, "count(*) FILTER (status IN ('open', 'in_progress', 'not_started'))::DOUBLE"),
    ("critical_item_count", "Critical Item Count", "items", 0, "count(*) FILTER (severity = 'critical')::DOUBLE"),
    ("readiness_completion_pct", "Readiness Completion %", "%", 1,
     "count(*) FILTER (status IN ('complete', 'closed'))::DOUBLE / count(*) * 100.0"),
]
MARKET = [
    ("total_revenue", "Total Revenue", "USD", 0, "coalesce(sum(revenue)::DOUBLE, 0)"),
    ("capacity_mw", "Total Capacity (MW)", "MW", 1, "coalesce(sum(capacity_mw)::DOUBLE, 0)"),
    ("leased_mw", "Total Leased (MW)", "MW", 1, "coalesce(sum(leased_mw)::DOUBLE, 0)"),
    ("contracted_kw", "Total Contracted (KW)", "KW", 0, "coalesce(sum(contracted_kw)::DOUBLE, 0)"),
    ("utilization_pct", "Utilization Rate", "%", 1, "sum(leased_mw)::DOUBLE / nullif(sum(capacity_mw)::DOUBLE, 0) * 100.0"),
    ("avg_price_per_kw", "Average Price per KW", "USD/KW", 2, "sum(revenue)::DOUBLE / nullif(sum(contracted_kw)::DOUBLE, 0)"),
]


def long(metrics, source: str, segments: list[str], rollups: list[list[str]], keys: list[str] | None = None,
         rounding: bool = True, changes: bool = False, name: str = "long") -> str:
    """CTEs ending in ``name``: long metrics as one query per rollup and metric."""
    keys = keys or []
    lead = "".join(f"{k}, " for k in keys)
    parts = []
    for rollup in rollups:
        level = "_".join(["date", *rollup]) if rollup else "date_only"
        shown = ", ".join(s if s in rollup else f"NULL::VARCHAR AS {s}" for s in segments)
        known = " AND ".join(["date IS NOT NULL", *[f"{s} IS NOT NULL" for s in rollup]])
        grouping = ", ".join([*keys, "date", *rollup])
        for metric_id, label, unit, decimals, expr in metrics:
            value = f"round_even({expr}, {decimals})" if rounding else expr
            parts.append(
                f"SELECT {lead}'{level}' AS rollup_level, date, {shown}, '{metric_id}' AS metric_id, '{label}' AS label, "
                f"{value} AS value, '{unit}' AS unit FROM {source} WHERE {known} GROUP BY {grouping}"
            )
    base = "\n  UNION ALL ".join(parts)
    if not changes:
        return f"{name} AS (\n  {base}\n)"
    window = ", ".join([*keys, "rollup_level", *segments, "metric_id"])
    digits = "CASE metric_id " + " ".join(f"WHEN '{m[0]}' THEN {m[3]}" for m in metrics) + " END"

    def rounded(expr: str) -> str:
        cases = " ".join(f"WHEN {d} THEN round_even({expr}, {d})" for d in sorted({m[3] for m in metrics}))
        return f"CASE {digits} {cases} END"

    return f"""base_{name} AS (
  {base}
),
lagged_{name} AS (
  SELECT *, lag(value) OVER (PARTITION BY {window} ORDER BY date) AS prior FROM base_{name}
),
{name} AS (
  SELECT {lead}rollup_level, date, {", ".join(segments)}, metric_id, label, value, unit,
    {rounded("prior")} AS prior_period_value, {rounded("value - prior")} AS period_change,
    round_even((value - prior) / nullif(prior, 0) * 100, 2) AS period_change_pct
  FROM lagged_{name}
)"""


READINESS_ROLLUPS = [[], ["category"], ["market"], ["category", "market"]]
MARKET_ROLLUPS = [[], ["region"], ["provider"], ["region", "provider"]]


def readiness(keys: list[str] | None = None, **options) -> str:
    return "WITH " + REQUIREMENTS + ",\n" + long(READINESS, "req", ["category", "market"], READINESS_ROLLUPS, keys, **options) + "\n"


def market(**options) -> str:
    return "WITH " + FACTS + ",\n" + long(MARKET, "facts", ["provider", "region"], MARKET_ROLLUPS, **options) + "\n"


DATE_STYLES = [
    "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%-d-%b-%y", "%-d-%b-%Y", "%B %-d %Y", "%B %-d, %Y", "%b %-d %Y", "%b %-d, %Y",
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%f",
]
PARSED_STYLES = "[" + ", ".join(f"'{s.replace('%-d', '%d')}'" for s in DATE_STYLES) + "]"


def _turn(key: str, choices: list[str]) -> str:
    return f"CASE {key} % {len(choices)} " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(choices)) + " END"


_STYLED = _turn("o_orderkey", [f"strftime(o_orderdate, '{s}')" for s in DATE_STYLES])
_AMOUNT = "format('{:,.2f}', o_totalprice)"
_BARE = "format('{:.2f}', o_totalprice)"

MESSY = f"""
messy AS (
  SELECT '  ' || o_orderkey || chr(160) AS order_key, {_STYLED} AS order_date,
    CASE WHEN o_orderstatus = 'P' THEN 'TBD' ELSE {_STYLED} END AS contract_start,
    {_turn("o_orderkey", [f"'$' || {_AMOUNT}", f"'(' || {_AMOUNT} || ')'", _BARE, f"'€ ' || {_BARE}", f"{_AMOUNT} || '%'"])} AS total_price,
    {_turn("o_orderkey", ["((o_orderkey % 50 + 1)::DECIMAL(6,0) * 0.1::DECIMAL(2,1))::VARCHAR || ' MW'", "(o_orderkey % 50) || 'kW'",
                          "(o_orderkey % 7)::VARCHAR", "'N/A'"])} AS rack_density,
    {_turn("o_orderkey", ["'ship soon'", "' NA'", "'none'", "'   '", "'hold, call 5,000 first'", "'NULL'", "'33%%'"])} AS ship_note,
    'C-' || o_custkey AS customer_id, o_orderstatus AS status_flag,
    'batch_' || lower(o_orderpriority[1]) || '.csv' AS source_file
  FROM orders, generate_series(1, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END) AS copies(i)
)"""

MESSY_COLUMNS = ["order_key", "order_date", "contract_start", "total_price", "rack_density", "ship_note", "customer_id", "status_flag"]
SENTINELS = "('', 'NA', 'N/A', 'null', 'NULL', 'none', 'None', 'NaN')"
_SPACE = "[\\s\\x{00a0}\\x{0085}\\x{2000}-\\x{200a}]"


def each(columns: list[str], expr) -> str:
    return ", ".join(f"{expr(c)} AS {c}" for c in columns)


def nulled(c: str) -> str:
    return f"CASE WHEN {c} NOT IN {SENTINELS} THEN {c} END"


def trimmed(c: str) -> str:
    return f"nullif(regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '')"


def plain(c: str) -> str:
    negative = f"CASE WHEN regexp_full_match({c}, '\\([0-9,.\\s]+\\)') THEN '-' || trim({c}[2:-2]) ELSE {c} END"
    unsigned = f"regexp_replace({negative}, '^[$€£¥]\\s*', '')"
    joined = f"regexp_replace(regexp_replace({unsigned}, '([0-9]),([0-9])', '\\1\\2', 'g'), '([0-9]),([0-9])', '\\1\\2', 'g')"
    return f"nullif(trim(regexp_replace(rtrim({joined}), '%$', '')), '')"


def kilowatts(c: str) -> str:
    amount = f"(try_cast(replace(regexp_extract({c}, '^([0-9,.]+)', 1), ',', '') AS DOUBLE) * CASE WHEN lower({c}) LIKE '%mw%' THEN 1000 ELSE 1 END)"
    text = f"CASE WHEN {amount} = floor({amount}) THEN {amount}::BIGINT::VARCHAR ELSE {amount}::VARCHAR END"
    return f"CASE WHEN regexp_full_match({c}, '[0-9,.]+\\s*(mw|kw)\\s*', 'i') THEN {text} ELSE {c} END"


def date_of(c: str) -> str:
    return f"try_strptime({c}, {PARSED_STYLES})::DATE"


MESSY_TEXT = MESSY + f""",
sourced AS (SELECT {each(MESSY_COLUMNS, nulled)}, source_file FROM messy),
cells AS (SELECT {each(MESSY_COLUMNS, trimmed)}, source_file FROM sourced),
numbers AS (SELECT {each(MESSY_COLUMNS, plain)}, source_file FROM cells),
standard AS (SELECT {each([c for c in MESSY_COLUMNS if c != "rack_density"], lambda c: c)}, {kilowatts("rack_density")} AS rack_density, source_file FROM numbers)"""

MESSY_TYPED = MESSY_TEXT + f""",
typed AS (
  SELECT order_key::BIGINT AS order_key, {date_of("order_date")} AS order_date,
    coalesce({date_of("contract_start")}::VARCHAR, contract_start) AS contract_start, total_price::DOUBLE AS total_price,
    rack_density::BIGINT AS rack_density, ship_note, customer_id, status_flag, source_file
  FROM standard
)"""
