import datetime as dt


def ts(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


def in_order(row):
    return tuple(str(v) for v in row)


def rows(df, *columns):
    """Rows as plain tuples in a stable order."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=in_order)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark, schema, data):
    return spark.createDataFrame(data, schema)
