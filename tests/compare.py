"""Run named queries and their SQL checks on the same tables and compare the rows."""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, (int, float)):
        return (1, f"{float(v):.6f}")
    return (2, str(v))


def _same(a, b) -> bool:
    if a is None or b is None:
        return a is b
    if isinstance(a, float) or isinstance(b, float):
        x, y = float(a), float(b)
        return x == y or (math.isnan(x) and math.isnan(y))
    return a == b


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and the SQL result; empty when they agree."""
    cols = sorted(df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return [f"columns {cols} vs {sorted(names)}"]
    kinds = dict(zip(names, (str(d[1]) for d in cur.description)))
    problems = []
    whole = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if kinds[f.name] != whole.get(t, kinds[f.name]):
            problems.append(f"type of {f.name}: {t} vs {kinds[f.name]}")
    pick = [names.index(c) for c in cols]
    theirs = sorted(([row[i] for i in pick] for row in cur.fetchall()),
                    key=lambda r: [_key(v) for v in r])
    ours = sorted(([row[c] for c in cols] for row in df.collect()),
                  key=lambda r: [_key(v) for v in r])
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs)
           if not all(_same(x, y) for x, y in zip(a, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0][0]} vs {bad[0][1]}")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    checks = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            n = ""
            if name in checks:
                problems = compare(df, con, checks[name])
            else:
                n, problems = f" rows-only {df.count()}", []
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t:.2f}s{n if not problems else ''}",
              *problems, sep="\n     " if problems else "", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, ".")
    raise SystemExit(main(sys.argv[1], sys.argv[2:]) > 0)
