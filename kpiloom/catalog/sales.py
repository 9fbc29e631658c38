"""Sales analyses and the load rules of the sales tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.catalog import sql as S
from kpiloom.catalog.registrar import query
from kpiloom.operators import sets
from kpiloom.plans import sales as sa
from kpiloom.plans import views
from kpiloom.session import scratch_path
from kpiloom.sources.versions import VersionedTables

WITH = f"WITH {S.SALES} "
RAW = f"WITH {S.SALES_RAW} "


def orders(spark, folder, by_order=False):
    return views.sales_orders(spark, folder, by_order)


SQL1 = WITH + f"SELECT {S.cents('sum(sales)')} AS total_revenue, {S.cents('sum(profit)')} AS total_profit, {S.money('sum(profit)::DOUBLE / nullif(sum(sales)::DOUBLE, 0) * 100')} AS profit_margin_pct FROM sales"
SQL2 = WITH + f"SELECT date_trunc('month', order_date)::DATE AS month, {S.cents('sum(sales)')} AS monthly_revenue, {S.cents('sum(profit)')} AS monthly_profit FROM sales GROUP BY 1 ORDER BY 1"
SQL3 = WITH + f"SELECT category, {S.cents('sum(sales)')} AS revenue, {S.cents('sum(profit)')} AS profit FROM sales JOIN products USING (product_id) GROUP BY category ORDER BY revenue DESC"
SQL4 = WITH + f"SELECT product_name, {S.cents('sum(sales)')} AS total_sales FROM sales JOIN products USING (product_id) GROUP BY product_name ORDER BY total_sales DESC, product_name LIMIT 10"
SQL5 = WITH + f"SELECT customer_id, {S.cents('sum(sales)')} AS customer_revenue FROM sales GROUP BY customer_id ORDER BY customer_revenue DESC, customer_id LIMIT 10"
SQL6 = WITH + (f"SELECT customer_id, count(DISTINCT order_id) AS total_orders, {S.cents('sum(sales)')} AS total_spent, "
               f"{S.money('sum(sales)::DOUBLE / count(DISTINCT order_id)')} AS avg_order_value FROM sales GROUP BY customer_id ORDER BY total_spent DESC")
SQL7 = WITH + f"SELECT region, {S.cents('sum(sales)')} AS revenue, {S.cents('sum(profit)')} AS profit FROM sales JOIN customers USING (customer_id) GROUP BY region ORDER BY revenue DESC"
SQL8 = WITH + ("SELECT CASE WHEN discount = 0 THEN 'No Discount' WHEN discount <= 0.2 THEN 'Low Discount' WHEN discount <= 0.4 THEN 'Medium Discount' ELSE 'High Discount' END AS discount_bucket, "
               f"count(*) AS order_count, {S.money('sum(profit)::DOUBLE / count(profit)')} AS avg_profit FROM sales GROUP BY 1 ORDER BY avg_profit DESC")
SQL9 = WITH + ("SELECT CASE WHEN order_count = 1 THEN 'One-time Customer' ELSE 'Repeat Customer' END AS customer_type, count(*) AS number_of_customers "
               "FROM (SELECT customer_id, count(DISTINCT order_id) AS order_count FROM sales GROUP BY customer_id) GROUP BY 1")
SQL10 = WITH + f"SELECT customer_id, {S.cents('sum(sales)')} AS total_revenue, rank() OVER (ORDER BY sum(sales) DESC) AS revenue_rank FROM sales GROUP BY customer_id ORDER BY revenue_rank"


@query("SQL1", SQL1)
def totals(spark, folder):
    return sa.revenue_totals(orders(spark, folder))


@query("SQL2", SQL2)
def by_month(spark, folder):
    return sa.monthly_trend(orders(spark, folder))


@query("SQL3", SQL3)
def by_category(spark, folder):
    return sa.revenue_by(orders(spark, folder), views.products(spark, folder), "product_id", "category")


@query("SQL4", SQL4)
def top_products(spark, folder):
    return sa.top_products(orders(spark, folder), views.products(spark, folder))


@query("SQL5", SQL5)
def top_customers(spark, folder):
    return sa.top_customers(orders(spark, folder))


@query("SQL6", SQL6)
def behaviour(spark, folder):
    return sa.customer_behaviour(orders(spark, folder, by_order=True))


@query("SQL7", SQL7)
def by_region(spark, folder):
    return sa.revenue_by(orders(spark, folder), views.customers(spark, folder), "customer_id", "region")


@query("SQL8", SQL8)
def by_discount(spark, folder):
    return sa.discount_impact(orders(spark, folder))


@query("SQL9", SQL9)
def repeat_or_not(spark, folder):
    return sa.repeat_customers(orders(spark, folder, by_order=True))


@query("SQL10", SQL10)
def ranked(spark, folder):
    return sa.ranked_customers(orders(spark, folder))


# The building blocks of the analyses, on other columns than above.
@query("AGG12", WITH + f"SELECT product_id AS customer_id, count(DISTINCT order_id) AS total_orders, {S.cents('sum(sales)')} AS total_spent, "
       f"{S.money('sum(sales)::DOUBLE / count(DISTINCT order_id)')} AS avg_order_value FROM sales GROUP BY product_id")
def product_behaviour(spark, folder):
    return sa.customer_behaviour(orders(spark, folder, by_order=True).withColumn("customer_id", F.col("product_id")))


_AGG13 = (WITH + f"SELECT {S.cents('sum(quantity * 100 + sales)')} AS total_revenue, {S.cents('sum(profit - discount * 100)')} AS total_profit, "
       f"{S.money('sum(profit - discount * 100)::DOUBLE / nullif(sum(quantity * 100 + sales)::DOUBLE, 0) * 100')} AS profit_margin_pct FROM sales")


@query("AGG13", _AGG13)
@query("AGG13_all", _AGG13)
def totals_with_charges(spark, folder):
    """A charge per piece is added to the revenue, and a cost of the discount is taken from the profit."""
    charged = {"sales": F.col("quantity") * 100 + F.col("sales"), "profit": F.col("profit") - F.col("discount") * 100}
    return sa.revenue_totals(orders(spark, folder).withColumns({k: v.cast("decimal(14,2)") for k, v in charged.items()}))


@query("AGG14", WITH + f"SELECT date_trunc('month', ship_date)::DATE AS month, {S.cents('sum(sales)')} AS monthly_revenue, {S.cents('sum(profit)')} AS monthly_profit FROM sales GROUP BY 1")
def by_shipping_month(spark, folder):
    return sa.monthly_trend(orders(spark, folder).withColumn("order_date", F.col("ship_date")))


@query("AGG15", WITH + f"SELECT CASE WHEN discount = 0 THEN 'No Discount' WHEN discount <= 0.2 THEN 'Low Discount' WHEN discount <= 0.4 THEN 'Medium Discount' ELSE 'High Discount' END AS discount_bucket, "
       f"count(*) AS order_count, {S.money('sum(sales)::DOUBLE / count(sales)')} AS avg_profit FROM (SELECT sales, discount * 5 AS discount FROM sales) GROUP BY 1")
def by_larger_discount(spark, folder):
    """Discounts five times as large reach every bucket."""
    return sa.discount_impact(orders(spark, folder).select("sales", F.col("sales").alias("profit"), (F.col("discount") * 5).alias("discount")))


_AGG16 = (WITH + "SELECT CASE WHEN n = 1 THEN 'One-time Customer' ELSE 'Repeat Customer' END AS customer_type, count(*) AS number_of_customers "
       "FROM (SELECT customer_id, product_id, count(DISTINCT order_id) AS n FROM sales GROUP BY customer_id, product_id) GROUP BY 1")


@query("AGG16", _AGG16)
@query("AGG16_all", _AGG16)
def products_bought_again_by_a_customer(spark, folder):
    """Every product of a customer, bought in one order or in more."""
    return sa.repeat_customers(orders(spark, folder, by_order=True).withColumn("customer_id", F.struct("customer_id", "product_id")))


@query("LIM1", WITH + f"SELECT ship_mode AS product_name, {S.cents('sum(sales)')} AS total_sales FROM sales GROUP BY 1 ORDER BY total_sales DESC, product_name LIMIT 2")
def top_shipping(spark, folder):
    modes = orders(spark, folder).select(F.col("ship_mode").alias("product_id"), "sales", "profit")
    names = modes.select("product_id", F.col("product_id").alias("product_name")).distinct()
    return sa.top_products(modes, names, 2)


@query("JN3", SQL3.replace("SELECT category", "SELECT sub_category").replace("GROUP BY category", "GROUP BY sub_category"))
def product_join(spark, folder):
    return sa.revenue_by(orders(spark, folder), views.products(spark, folder), "product_id", "sub_category")


@query("JN4", SQL7.replace("SELECT region", "SELECT segment").replace("GROUP BY region", "GROUP BY segment"))
def customer_join(spark, folder):
    return sa.revenue_by(orders(spark, folder), views.customers(spark, folder), "customer_id", "segment")


@query("WIN4", WITH + f"SELECT product_id, {S.cents('sum(sales)')} AS total_revenue, rank() OVER (ORDER BY sum(sales) DESC) AS revenue_rank FROM sales GROUP BY product_id")
def ranked_products(spark, folder):
    renamed = orders(spark, folder).select(F.col("product_id").alias("customer_id"), "sales")
    return sa.ranked_customers(renamed).withColumnRenamed("customer_id", "product_id")


@query("SET4", RAW + "SELECT DISTINCT customer_id, segment, region, country FROM raw")
def distinct_customers(spark, folder):
    return views.sales_raw(spark, folder).select("customer_id", "segment", "region", "country").distinct()


_ORDER_COLUMNS = ["order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id", "quantity", "sales", "discount", "profit"]
_REST = ", ".join(c for c in _ORDER_COLUMNS if c not in ("order_id", "product_id"))


@query("SET5", WITH + f"""SELECT order_id, product_id, sales::DOUBLE AS sales, ship_mode, quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY {_REST}) AS place FROM sales) WHERE place = 1 AND product_id NOT IN (SELECT product_id FROM products WHERE category = 'ECONOMY')""")
def insert_ignored(spark, folder):
    """Rows to add beside a target that already holds every order of economy products."""
    facts = orders(spark, folder, by_order=True).select(*_ORDER_COLUMNS)
    economy = views.products(spark, folder).filter(F.col("category") == "ECONOMY")
    target = facts.join(economy, "product_id", "left_semi")
    added = sets.insert_ignore(facts, target, ["order_id", "product_id"])
    return added.select("order_id", "product_id", F.col("sales").cast("double").alias("sales"), "ship_mode", "quantity")


@query("SET5_single", RAW + "SELECT customer_id, segment, region, country FROM (SELECT DISTINCT customer_id, segment, region, country FROM raw)")
def insert_ignored_single(spark, folder):
    raw = views.sales_raw(spark, folder).select("customer_id", "segment", "region", "country")
    return sets.insert_ignore(raw, raw.limit(0), ["customer_id"])


@query("SET2", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders EXCEPT SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice > 100000")
def set_difference(spark, folder):
    rows = views.table(spark, folder, "orders")
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    tables = VersionedTables(spark, scratch_path(spark, "known"))
    tables.append_new("orders", rows.filter(F.col("o_totalprice") > 100000).select(*columns))
    return tables.rows_not_in("orders", rows.select(*columns))


@query("LOAD1", RAW + "SELECT order_id, product_id, strptime(order_date, '%m/%d/%Y')::DATE AS order_date, count(*) AS n FROM raw GROUP BY ALL")
def text_dates(spark, folder):
    typed = sa.typed_orders(views.sales_raw(spark, folder))
    return typed.groupBy("order_id", "product_id", "order_date").agg(F.count(F.lit(1)).alias("n"))


@query("LOAD2", RAW + "SELECT order_id, sales::DECIMAL(10,2)::DOUBLE AS sales, discount::DECIMAL(5,2)::DOUBLE AS discount, profit::DECIMAL(10,2)::DOUBLE AS profit, quantity::INTEGER AS quantity FROM raw")
def text_amounts(spark, folder):
    typed = sa.typed_orders(views.sales_raw(spark, folder))
    amounts = [F.col(c).cast("double").alias(c) for c in ("sales", "discount", "profit")]
    return typed.select("order_id", *amounts, "quantity")
