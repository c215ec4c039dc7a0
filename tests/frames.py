"""Small frames for tests, and a plain count of rows."""

from collections import Counter

LINE_TYPES = (
    "order_id long, user_id long, order_number int, order_dow int, order_hour_of_day int, "
    "days_since_prior_order double, product_id long, add_to_cart_order int, reordered int, "
    "department_id int, department string, product_name string"
)


def lines(spark, rows):
    return spark.createDataFrame(rows, LINE_TYPES)


def line(order=1, user=1, number=1, dow=0, hour=0, days=None, product=1, cart=1, reordered=0, dep_id=1, dep="d1", name="n1"):
    return (order, user, number, dow, hour, days, product, cart, reordered, dep_id, dep, name)


def bag(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())
