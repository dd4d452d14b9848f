"""Order-insensitive comparison of a Spark result with its DuckDB oracle."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is not None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in row)


# Spark type name -> DuckDB type names that carry the same values.
TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    expected_rows = cur.fetchall()
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        spark_type = f.dataType.simpleString()
        if spark_type in TYPES and kinds[f.name] not in TYPES[spark_type]:
            out.append(f"type of {f.name}: {spark_type} != {kinds[f.name]}")
        elif spark_type not in TYPES:
            out.append(f"type of {f.name}: {spark_type} (oracle {kinds[f.name]})")
    order = sorted(names)
    spots = [names.index(c) for c in order]
    expected = sorted((tuple(_plain(r[i]) for i in spots) for r in expected_rows), key=_key)
    got = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=_key)
    if len(got) != len(expected):
        out.append(f"rows {len(got)} != {len(expected)}")
    for g, e in zip(got, expected):
        if g != e:
            out.append(f"first difference {dict(zip(order, g))} != {dict(zip(order, e))}")
            break
    return out


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
