"""Run registered queries and their SQL side by side and report every difference."""

from __future__ import annotations

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(zip(*[table.column(n).to_pylist() for n in names]), key=repr) if table.num_rows else []


def _plain(value):
    if hasattr(value, "replace") and hasattr(value, "tzinfo"):
        return value.replace(tzinfo=None)
    return 0.0 if isinstance(value, float) and value == 0 else value


def differences(mine, theirs) -> list[str]:
    """What differs between two Arrow tables, ignoring row and column order."""
    out = []
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(mine.column_names)} != {sorted(theirs.column_names)}"]
    for name in sorted(mine.column_names):
        a, b = str(mine.schema.field(name).type), str(theirs.schema.field(name).type)
        if a.split("[")[0] != b.split("[")[0]:
            out.append(f"type of {name}: {a} != {b}")
    left = sorted((tuple(map(_plain, r)) for r in _rows(mine)), key=repr)
    right = sorted((tuple(map(_plain, r)) for r in _rows(theirs)), key=repr)
    if len(left) != len(right):
        out.append(f"{len(left)} rows != {len(right)}")
    bad = [(x, y) for x, y in zip(left, right) if x != y]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out


def check(spark, con, folder: str, name: str, build, sql: str | None) -> list[str]:
    mine = build(spark, folder).toArrow()
    if sql is None:
        return [] if mine.num_rows else ["no rows"]
    return differences(mine, con.execute(sql).to_arrow_table())


def main() -> None:
    import __spark_entry__ as entry
    from demandloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(), connect(folder)
    sql = entry.oracle_sql()
    failed = []
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problems = check(spark, con, folder, name, build, sql.get(name))
        except Exception as e:  # report and go on to the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind:4} {time.time() - start:6.1f}s {name} {problems or ''}", flush=True)
        if problems:
            failed.append(name)
    missing = set(sql) - set(entry.queries())
    print(f"{len(failed)} failed {failed}; sql without query {sorted(missing)}")


if __name__ == "__main__":
    main()
