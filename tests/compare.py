"""Compare a query's rows with its SQL counterpart's, order aside."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def kind(name: str) -> str:
    name = name.lower()
    for k, words in {
        "int": ("int", "long", "hugeint"), "float": ("double", "float", "decimal"),
        "text": ("string", "varchar"), "bool": ("bool",),
    }.items():
        if any(w in name for w in words):
            return k
    return name


def differences(df, con, sql):
    rel = con.sql(sql)
    names, types = rel.columns, [str(t) for t in rel.types]
    got_types = dict(df.dtypes)
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for n, t in zip(names, types):
        if kind(got_types[n]) != kind(t):
            out.append(f"type of {n}: {got_types[n]} vs {t}")
    want = rows_of(names, rel.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want != got:
        out.append(f"{sum(got.values())} rows vs {sum(want.values())}")
        order = sorted(names)
        out += [f"only here: {str(dict(zip(order, r)))[:600]}" for r in list((got - want))[:2]]
        out += [f"only in SQL: {str(dict(zip(order, r)))[:600]}" for r in list((want - got))[:2]]
    elif not got:
        out.append("no rows to compare")
    return out
