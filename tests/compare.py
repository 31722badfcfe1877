"""Comparison of a Spark result with a DuckDB one: sorted columns, unordered rows, nine digits."""

import decimal


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if v != v else f"{float(v):.9g}" if v else "0"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(norm(r[i]) for i in order) for r in data)


def same(spark_df, relation):
    a = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    b = rows([str(c) for c in relation.columns], relation.fetchall())
    assert a[0] == b[0]
    assert a[1] == b[1]
