"""Comparing a DataFrame with the answer of the SQL oracle, as bags of rows."""

from collections import Counter

import duckdb

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir=SF_DIR):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(row) for row in df.collect()])


def oracle_bag(connection, sql):
    result = connection.execute(sql)
    return bag([column[0] for column in result.description], result.fetchall())


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plan_nodes(df):
    """(kind, text) of every node of the plan that ran, subqueries included; what is reused counts where it was made.

    Kinds are class names such as FileSourceScanExec, ShuffleExchangeExec or SortMergeJoinExec.
    """
    df.collect()

    def items(sequence):
        return [sequence.apply(i) for i in range(sequence.size())]

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            return
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
            return
        if kind.endswith("QueryStageExec"):
            yield from walk(node.plan())
            return
        yield kind, node.simpleString(10_000)
        for below in [*items(node.children()), *items(node.subqueries())]:
            yield from walk(below)

    return list(walk(df._jdf.queryExecution().executedPlan()))
