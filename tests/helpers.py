"""Small helpers shared by the tests."""

from pyspark.sql import functions as F


def apply(spark, values, *functions, type_="string"):
    """Results of column functions over a list of values, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {type_}")
    columns = [f(F.col("x")).alias(f"y{n}") for n, f in enumerate(functions)]
    found = [tuple(r)[1:] for r in sorted(rows.select("i", *columns).collect(), key=lambda r: r["i"])]
    return [r[0] for r in found] if len(functions) == 1 else found


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
