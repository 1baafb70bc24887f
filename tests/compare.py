"""Run a registered query and its SQL on the same tables and compare every value."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def text(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return str(value)


def tuples(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(text(r[i]) for i in order) for r in records)


def difference(spark, con, sf_dir, query, sql):
    """(message or None, row count)."""
    df = query(spark, sf_dir)
    relation = con.sql(sql)
    want_columns, have_columns = relation.columns, df.columns
    if sorted(want_columns) != sorted(have_columns):
        return f"columns {sorted(set(want_columns) ^ set(have_columns))}", 0
    kinds = {
        "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
        "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
    }
    types = dict(zip(want_columns, map(str, relation.types), strict=True))
    odd = [
        f"{c}: {t} vs {types[c]}" for c, t in df.dtypes if kinds.get(types[c], types[c]) != t
    ]
    if odd:
        return f"types {odd}", 0
    have = tuples(have_columns, [tuple(r) for r in df.collect()])
    want = tuples(want_columns, relation.fetchall())
    if have == want:
        return None, sum(have.values())
    extra, lost = have - want, want - have
    return (
        f"{sum(extra.values())} extra, {sum(lost.values())} lost of {sum(want.values())}\n"
        f"  have {sorted(extra)[:2]}\n  want {sorted(lost)[:2]}",
        sum(have.values()),
    )
