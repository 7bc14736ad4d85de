"""Compare a Spark result with a DuckDB one as bags of rows."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return db


_KINDS = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def spark_result(df):
    names = sorted(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = Counter(tuple(_cell(row[n]) for n in names) for row in df.collect())
    return kinds, rows


def duck_result(db, sql):
    cursor = db.execute(sql)
    heads = [(d[0], str(d[1])) for d in cursor.description]
    order = sorted(range(len(heads)), key=lambda i: heads[i][0])
    rows = Counter(tuple(_cell(row[i]) for i in order) for row in cursor.fetchall())
    return {name: _KINDS.get(kind, kind) for name, kind in heads}, rows
