"""Run registered queries next to their SQL and compare whole results.

As a script: ``python -m tests.compare SF_DIR [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    return [column[0] for column in result.description], result.fetchall()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def ordered(columns, rows):
    """Rows with columns in name order, sorted."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in places) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def difference(spark, sf_dir, run, sql) -> str | None:
    """None when the query and the SQL agree, else what differs."""
    df = run(spark, sf_dir)
    got = ordered(df.columns, df.collect())
    want = ordered(*sql_rows(sf_dir, sql))
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    extra = sorted(set(got[1]) - set(want[1]), key=repr)
    lost = sorted(set(want[1]) - set(got[1]), key=repr)
    return (f"{len(got[1])} rows != {len(want[1])}; only query {extra[:3]}; "
            f"only sql {lost[:3]}")


def main(argv):
    import __spark_entry__ as entry
    from harvestry.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8",
                                         "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sqls, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = difference(spark, argv[0], run, sqls[name])
            else:
                problem = None if run(spark, argv[0]).count() else "no rows"
        except Exception as error:  # report and go on with the other queries
            problem = str(error)[:1500]
        bad += problem is not None
        kind = "sql" if name in sqls else "rows"
        print(f"{name:28s} {kind:5s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
