"""Compare registered queries with their oracle SQL on one data folder.

    python tools/check_oracle.py [folder] [name-prefix …]
"""

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from cellspark.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return "D" + str(v.normalize())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items(), key=str)) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return repr(v)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in data)


FAMILY = {"bigint": "int", "int": "int", "integer": "int", "smallint": "int", "tinyint": "int",
          "hugeint": "huge", "varchar": "string", "timestamp_ntz": "timestamp"}


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = local_session()
    from cellspark.plans import ORACLE, QUERIES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    bad = []
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            got = [tuple(r) for r in df.collect()]
        except Exception as e:
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
            bad.append(name)
            continue
        took = time.time() - start
        if name not in ORACLE:
            print(f"rows {name}: {len(got)} rows, no oracle, {took:.1f}s", flush=True)
            if not got:
                bad.append(name)
            continue
        start = time.time()
        try:
            cur = con.execute(ORACLE[name])
            cols = [d[0] for d in cur.description]
            types = [str(d[1]).lower() for d in cur.description]
            want = cur.fetchall()
        except Exception as e:
            print(f"FAIL {name}: oracle {str(e)[:600]}", flush=True)
            bad.append(name)
            continue
        sql_took = time.time() - start
        notes = []
        if sorted(cols) != sorted(df.columns):
            notes.append(f"columns {sorted(df.columns)} vs {sorted(cols)}")
        else:
            a, b = rows_of(df.columns, got), rows_of(cols, want)
            if a != b:
                notes.append(f"{len(got)} vs {len(want)} rows; only spark {list((a - b).items())[:3]}; "
                             f"only sql {list((b - a).items())[:3]}")
            mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            for c, t in zip(cols, types):
                x = mine[c]
                if FAMILY.get(x, x) != FAMILY.get(t, t):
                    notes.append(f"type {c}: {x} vs {t}")
        if not got:
            notes.append("empty")
        if notes:
            bad.append(name)
            print(f"DIFF {name} ({took:.1f}s): " + " | ".join(notes), flush=True)
        else:
            print(f"ok   {name}: {len(got)} rows, {took:.1f}s, sql {sql_took:.1f}s", flush=True)
    print(f"{len(bad)} problems: {bad}")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
