"""Ten analyses of a sales star schema, and the load rules of its tables.

``orders`` has order_id, order_date, customer_id, product_id, sales, profit, discount (amounts as
decimals); ``products`` and ``customers`` are keyed by their ids. Facts are summed per key before they
meet a dimension, so joins move one row per key and a popular key is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.numbers import ratio_in_cents
from kpiloom.operators.ordering import with_rank_descending

#: Decimals of the amounts.
MONEY_DECIMALS = 2


def cents(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def share_percent(part: Column, whole: Column) -> Column:
    return ratio_in_cents(part, whole, MONEY_DECIMALS, 100)


def revenue_totals(orders: DataFrame) -> DataFrame:
    sums = orders.agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    return sums.select(cents(F.col("s")).alias("total_revenue"), cents(F.col("p")).alias("total_profit"),
                       share_percent(F.col("p"), F.col("s")).alias("profit_margin_pct"))


def monthly_trend(orders: DataFrame) -> DataFrame:
    month = F.trunc("order_date", "month").alias("month")
    return orders.groupBy(month).agg(cents(F.sum("sales")).alias("monthly_revenue"), cents(F.sum("profit")).alias("monthly_profit")).orderBy("month")


def _per_key(orders: DataFrame, key: str) -> DataFrame:
    return orders.groupBy(key).agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))


def revenue_by(orders: DataFrame, dimension: DataFrame, key: str, attribute: str) -> DataFrame:
    """Revenue and profit by an attribute of a dimension."""
    return (
        _per_key(orders, key).join(dimension.select(key, attribute), key).groupBy(attribute)
        .agg(cents(F.sum("s")).alias("revenue"), cents(F.sum("p")).alias("profit")).orderBy(F.desc("revenue"))
    )


def top_products(orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    return (
        _per_key(orders, "product_id").join(products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name").agg(cents(F.sum("s")).alias("total_sales"))
        .orderBy(F.desc("total_sales"), "product_name").limit(n)
    )


def top_customers(orders: DataFrame, n: int = 10) -> DataFrame:
    return (
        orders.groupBy("customer_id").agg(cents(F.sum("sales")).alias("customer_revenue"))
        .orderBy(F.desc("customer_revenue"), "customer_id").limit(n)
    )


def _orders_per_customer(orders: DataFrame) -> DataFrame:
    """Distinct orders and sales per customer; grouping by order first spreads a customer with many orders."""
    per_order = orders.groupBy("customer_id", "order_id").agg(F.sum("sales").alias("s"))
    return per_order.groupBy("customer_id").agg(F.count("order_id").alias("total_orders"), F.sum("s").alias("s"))


def customer_behaviour(orders: DataFrame) -> DataFrame:
    average = ratio_in_cents(F.col("s"), F.col("total_orders"), MONEY_DECIMALS)
    return _orders_per_customer(orders).select(
        "customer_id", "total_orders", cents(F.col("s")).alias("total_spent"), average.alias("avg_order_value")
    ).orderBy(F.desc("total_spent"))


def discount_impact(orders: DataFrame) -> DataFrame:
    d = F.col("discount")
    bucket = (
        F.when(d == 0, "No Discount").when(d <= 0.2, "Low Discount").when(d <= 0.4, "Medium Discount").otherwise("High Discount")
    )
    summed = orders.groupBy(bucket.alias("discount_bucket")).agg(
        F.count(F.lit(1)).alias("order_count"), F.count("profit").alias("n"), F.sum("profit").alias("p"))
    return summed.select("discount_bucket", "order_count",
                         ratio_in_cents(F.col("p"), F.col("n"), MONEY_DECIMALS).alias("avg_profit")).orderBy(F.desc("avg_profit"))


def repeat_customers(orders: DataFrame) -> DataFrame:
    kind = F.when(F.col("total_orders") == 1, "One-time Customer").otherwise("Repeat Customer")
    return _orders_per_customer(orders).groupBy(kind.alias("customer_type")).agg(F.count(F.lit(1)).alias("number_of_customers"))


def ranked_customers(orders: DataFrame) -> DataFrame:
    totals = orders.groupBy("customer_id").agg(F.sum("sales").alias("s"))
    return with_rank_descending(totals, "s", "revenue_rank").select(
        "customer_id", cents(F.col("s")).alias("total_revenue"), "revenue_rank").orderBy("revenue_rank")


def us_date(c: Column) -> Column:
    """month/day/year text to DATE, null when it is none."""
    return F.try_to_date(c, "M/d/yyyy")


def typed_orders(raw: DataFrame) -> DataFrame:
    """Raw order text to the declared types."""
    return raw.withColumns({
        "order_date": us_date(F.col("order_date")), "quantity": F.col("quantity").try_cast("int"),
        "sales": F.col("sales").try_cast("decimal(10,2)"), "discount": F.col("discount").try_cast("decimal(5,2)"),
        "profit": F.col("profit").try_cast("decimal(10,2)"),
    })
