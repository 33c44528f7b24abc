"""Small seller tables as text, the way files deliver them."""

ORDER_HEADER = ["account_name", "sku", "product-name", "purchase-date", "item-price", "quantity"]
STOCK_HEADER = ["account_name", "sku", "asin", "product-name", "afn-fulfillable-quantity"]
DAY = "2024-11-25T07:59:00+00:00"


def orders(spark, *rows):
    """Rows of (sku, product, price, quantity[, date[, account]])."""
    full = [(*r, *(DAY, "ab")[len(r) - 4:]) for r in rows]
    table = [(account, sku, product, date, price, quantity) for sku, product, price, quantity, date, account in full]
    return spark.createDataFrame(table, ", ".join(f"`{c}` string" for c in ORDER_HEADER))


def stock(spark, *rows):
    """Rows of (sku, units[, account])."""
    full = [(*r, *("ab",)[len(r) - 2:]) for r in rows]
    table = [(account, sku, f"B{sku}", f"name of {sku}", units) for sku, units, account in full]
    return spark.createDataFrame(table, ", ".join(f"`{c}` string" for c in STOCK_HEADER))


def listed(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def ranked(summary):
    """(sku, product, units, revenue, stock) in report order."""
    rows = summary.orderBy("report_rank").collect()
    assert [r.report_rank for r in rows] == list(range(1, len(rows) + 1))
    return [(r.sku, r.product_name, r.units_sold, r.revenue, r.remaining_units) for r in rows]
