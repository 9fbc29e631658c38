"""Working views over the provided tables, shaped like the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Market segment names of the test data and the requirement categories they stand for.
CATEGORY_OF_SEGMENT = {
    "AUTOMOBILE": "power",
    "BUILDING": "site_control",
    "FURNITURE": "commercial",
    "HOUSEHOLD": "capital",
    "MACHINERY": "permitting",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of the larger table that one task joins, on average, where almost every row is a group of its own.
ROWS_PER_TASK = 1_000_000


def tasks_for(rows: DataFrame) -> int:
    """Number of tasks for a join and grouping that keep almost every row; 1 where one task can take them all.

    Adaptive execution merges shuffle partitions by their compressed bytes, and millions of narrow rows fit into those:
    dealt into this number of partitions instead, each task gets a bounded number of rows, whatever the size of the table.
    """
    tasks = -(-rows.count() // ROWS_PER_TASK)
    return max(tasks, rows.sparkSession.sparkContext.defaultParallelism) if tasks > 1 else 1


def month_of(column: str):
    return F.trunc(F.col(column).cast("date"), "month")


def customers_with_place(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def requirements(spark: SparkSession, folder: str) -> DataFrame:
    """One requirement per order: month, project, portfolio, category, market, status, severity."""
    orders = table(spark, folder, "orders")
    joined = orders.join(customers_with_place(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
    category = F.create_map(*[F.lit(x) for pair in CATEGORY_OF_SEGMENT.items() for x in pair])
    priority = F.col("o_orderpriority")
    return joined.select(
        month_of("o_orderdate").alias("date"),
        F.col("o_custkey").alias("project_id"),
        F.col("n_name").alias("portfolio"),
        F.when(F.col("o_custkey") % 97 != 0, category[F.col("c_mktsegment")]).alias("category"),
        F.col("r_name").alias("market"),
        F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "P", "in_progress")
        .otherwise("open").alias("status"),
        F.when(priority == "1-URGENT", "critical").when(priority == "2-HIGH", "high").when(priority == "5-LOW", "low")
        .otherwise("medium").alias("severity"),
    )


def _money(column: str, digits: int = 2):
    return F.col(column).cast(f"decimal(12,{digits})")


def market_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue and capacity per order line; exact decimals so that sums do not depend on order."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers_with_place(spark, folder), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        month_of("o_orderdate").alias("date"),
        (_money("l_extendedprice") * (1 - _money("l_discount"))).cast("decimal(18,4)").alias("revenue"),
        _money("l_quantity").alias("capacity_mw"),
        (_money("l_quantity") * (1 - _money("l_tax"))).cast("decimal(18,4)").alias("leased_mw"),
        _money("l_extendedprice").alias("contracted_kw"),
        F.when(F.col("o_custkey") % 97 != 0, F.col("r_name")).alias("region"),
        F.col("c_mktsegment").alias("provider"),
    )


def sales_orders(spark: SparkSession, folder: str, by_order: bool = False) -> DataFrame:
    """Order lines as sales facts with fixed-decimal amounts. ``by_order``: to be grouped by order, see `tasks_for`."""
    lines, heads = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    tasks = tasks_for(lines) if by_order else 1
    if tasks > 1:
        lines, heads = lines.repartition(tasks, "l_orderkey"), heads.repartition(tasks, "o_orderkey")
    joined = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    price = _money("l_extendedprice")
    net = price * (1 - _money("l_discount"))
    return joined.select(
        F.col("l_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"), F.col("l_returnflag").alias("ship_mode"),
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), net.cast("decimal(10,2)").alias("sales"),
        F.col("l_discount").cast("decimal(5,2)").alias("discount"),
        (net - price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(10,2)").alias("profit"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return customers_with_place(spark, folder).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"), F.col("n_name").alias("country"),
    )


def sales_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The flat text table a sales export arrives as: every value is text, one row per order line."""
    facts = sales_orders(spark, folder).join(customers(spark, folder), "customer_id").join(products(spark, folder), "product_id")
    as_text = {c: F.col(c).cast("string") for c in ("order_id", "customer_id", "product_id", "quantity", "discount", "profit")}
    return facts.withColumns(as_text | {
        "order_date": F.date_format("order_date", "MM/dd/yyyy"), "ship_date": F.date_format("ship_date", "MM/dd/yyyy"),
        "sales": F.col("sales").cast("decimal(12,4)").cast("string"),
    })


DATE_STYLES = [
    "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "d-MMM-yy", "d-MMM-yyyy", "MMMM d yyyy", "MMMM d, yyyy", "MMM d yyyy",
    "MMM d, yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
]


def _by_turn(key: str, choices: list):
    """One of the choices per row, chosen by the key in turn."""
    result = choices[-1]
    for i, choice in list(enumerate(choices))[-2::-1]:
        result = F.when(F.col(key) % len(choices) == i, choice).otherwise(result)
    return result


def messy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a messy export: padded cells, thirteen date styles, dressed numbers, units, sentinels, repeats."""
    key, amount = "o_orderkey", F.format_number("o_totalprice", 2)
    bare = F.replace(amount, F.lit(","), F.lit(""))
    styled = _by_turn(key, [F.date_format("o_orderdate", style) for style in DATE_STYLES])
    tenth = (F.col(key) % 50 + 1).cast("decimal(6,0)") * F.lit("0.1").cast("decimal(2,1)")
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(1)
    return table(spark, folder, "orders").select(
        F.concat(F.lit("  "), F.col(key).cast("string"), F.lit(" ")).alias(" Order Key "),
        styled.alias("Order-Date"),
        F.when(F.col("o_orderstatus") == "P", "TBD").otherwise(styled).alias("Contract Start"),
        _by_turn(key, [F.concat(F.lit("$"), amount), F.concat(F.lit("("), amount, F.lit(")")), bare,
                       F.concat(F.lit("€ "), bare), F.concat(amount, F.lit("%"))]).alias("Total Price ($)"),
        _by_turn(key, [F.concat(tenth.cast("string"), F.lit(" MW")), F.concat((F.col(key) % 50).cast("string"), F.lit("kW")),
                       (F.col(key) % 7).cast("string"), F.lit("N/A")]).alias("Rack Density"),
        _by_turn(key, [F.lit("ship soon"), F.lit(" NA"), F.lit("none"), F.lit("   "), F.lit("hold, call 5,000 first"),
                       F.lit("NULL"), F.lit("33%%")]).alias("Ship Note"),
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("Customer ID"),
        F.col("o_orderstatus").alias("Status/Flag"),
        F.concat(F.lit("batch_"), F.lower(F.substring("o_orderpriority", 1, 1)), F.lit(".csv")).alias("source_file"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as wide intake answers, one row per project."""
    key = "c_custkey"
    serial = (F.col(key) % 3000 + 43000).cast("string")
    day = F.date_add(F.lit("2021-01-01").cast("date"), (F.col(key) % 900).cast("int"))
    return table(spark, folder, "customer").select(
        _by_turn(key, [serial, day.cast("string"), F.date_format(day, "MM/dd/yyyy"), F.date_format(day, "dd/MM/yyyy"),
                       F.date_format(day, "yyyy/MM/dd"), F.lit("soon")]).alias("assessment_date"),
        F.when(F.col(key) % 50 == 7, "").otherwise(F.concat(F.lit(" P"), F.col(key).cast("string"), F.lit(" "))).alias("project_id"),
        F.col("c_name").alias("client_name"),
        _by_turn(key, [F.lit("NAM"), F.lit("NAM, EMEA"), F.lit(" "), F.lit(None).cast("string"), F.lit(" APAC ")]).alias("preferred_markets"),
        _by_turn(key, [F.lit("Yes"), F.lit("no"), F.lit("In Progress"), F.lit("N/A"), F.lit("Board approved"), F.lit("0"),
                       F.lit(None).cast("string"), F.lit("Closed")]).alias("decision_makers_identified"),
        F.when(F.col(key) % 9 != 0, F.col("c_acctbal")).otherwise(0.0).alias("initial_critical_it_mw"),
        (F.col(key) % 4 == 0).alias("power_secured"),
        day.alias("target_live_date"),
        F.col("c_mktsegment").alias("use_case"),
    )


# A declared requirement map for the answers above.
REQUIREMENT_ROWS = [
    {"requirement_id": "R1", "requirement_name": "Decision makers named", "category": "decision", "severity": "high",
     "intake_field": "decision_makers_identified", "answer_yes_status": "complete", "answer_no_status": "not_started",
     "answer_partial_status": "in_progress", "default_status": "open", "default_notes": "Ask the sponsor.", "market_scope": "Global"},
    {"requirement_id": "R2", "requirement_name": "Critical load sized", "category": "capacity", "severity": "critical",
     "intake_field": "initial_critical_it_mw", "answer_yes_status": "closed", "answer_no_status": "open",
     "default_status": "not_started", "market_scope": ""},
    {"requirement_id": "R3", "requirement_name": "Power secured", "category": "power", "severity": "critical",
     "intake_field": "power_secured", "answer_yes_status": "complete", "default_status": "open", "default_notes": "Utility letter missing."},
    {"requirement_id": "R4", "requirement_name": " Budget confirmed ", "category": "capital", "severity": "medium",
     "intake_field": "budget_confirmed", "answer_yes_status": "complete", "default_status": "open", "default_notes": " To be asked ",
     "market_scope": "EMEA"},
    {"requirement_id": "R5", "requirement_name": "Market brief written", "category": "market", "severity": "low",
     "intake_field": " ", "default_status": "in_progress", "default_notes": "", "market_scope": "NAM"},
    {"requirement_id": "R6", "requirement_name": "Use case stated", "category": "technical", "severity": "medium",
     "intake_field": "use_case", "answer_yes_status": "", "default_status": "open", "market_scope": "Global"},
]
