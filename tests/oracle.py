"""Run a registered query beside its SQL and compare types, columns and values."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

DUCK_TO_SPARK = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>", "BOOLEAN": "boolean",
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, con, sql):
    """An empty list when the two sides agree."""
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    names = sorted(types)
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} / {names}"]
    spark_types = dict(df.dtypes)
    found = [
        f"type of {n}: {spark_types[n]} / {types[n]}"
        for n in names if DUCK_TO_SPARK.get(types[n]) != spark_types[n]
    ]
    at = [list(types).index(n) for n in names]
    want = _sorted([tuple(row[i] for i in at) for row in cur.fetchall()])
    got = _sorted([tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()])
    if len(want) != len(got):
        found.append(f"rows {len(got)} / {len(want)}")
    elif want != got:
        i = next(i for i in range(len(want)) if want[i] != got[i])
        found.append(f"row {i}: {got[i]} / {want[i]}"[:400])
    return found
