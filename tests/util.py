"""Small helpers shared by the tests."""


def rows(frame, *columns):
    got = frame.select(*columns).collect() if columns else frame.collect()
    return sorted((tuple(r) for r in got), key=lambda r: tuple((x is None, str(x)) for x in r))


def one(spark, expr, **values):
    """The value of a column function over one row of string columns."""
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(expr.alias("x")).first()["x"]
