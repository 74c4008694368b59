"""Runs a registered query and its SQL side by side."""

import glob
import math
import os

import duckdb

FAMILIES = {"int": "int", "bigint": "int", "integer": "int", "hugeint": "int", "string": "text",
            "varchar": "text", "double": "real", "boolean": "bool"}


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _plain(value):
    return 0.0 if isinstance(value, float) and (value == 0 or math.isnan(value)) else value


def spark_table(frame):
    names = sorted(frame.columns)
    rows = [tuple(_plain(v) for v in row) for row in frame.select(*names).collect()]
    types = {field.name: field.dataType.simpleString() for field in frame.schema}
    return names, types, sorted(rows, key=_key)


def duck_table(con, sql):
    result = con.execute(sql)
    columns = [item[0] for item in result.description]
    types = {item[0]: str(item[1]).lower() for item in result.description}
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], types, sorted(rows, key=_key)


def differences(frame, con, sql):
    """Empty text when both sides agree in names, types, rows and values."""
    names, types, rows = spark_table(frame)
    duck_names, duck_types, duck_rows = duck_table(con, sql)
    if names != duck_names:
        return f"names {names} / {duck_names}"
    for name in names:
        if types[name] != {"integer": "int", "varchar": "string"}.get(duck_types[name], duck_types[name]):
            return f"type of {name}: {types[name]} / {duck_types[name]}"
    if len(rows) != len(duck_rows):
        return f"{len(rows)} rows / {len(duck_rows)} rows"
    for left, right in zip(rows, duck_rows):
        if left != right:
            return f"{left} / {right}"
    return ""
