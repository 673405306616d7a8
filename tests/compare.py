"""Comparison of two results as bags of rows, columns taken by name."""

from collections import Counter


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark_df, relation, limit=3):
    """Rows only Spark returned and rows only the SQL returned; empty when equal."""
    assert sorted(spark_df.columns) == sorted(relation.columns)
    ours = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = bag(relation.columns, relation.fetchall())
    assert sum(ours.values()) == sum(theirs.values())
    return list((ours - theirs).items())[:limit], list((theirs - ours).items())[:limit]
