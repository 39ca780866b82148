"""Run registered queries against their SQL: ``python tests/check_all.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import connect, run_query, run_sql  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from loomstat import build_session  # noqa: E402

FAMILIES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("check", master="local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, function in queries().items():
        if names and name not in names:
            continue
        try:
            frame, (columns, rows), took = run_query(spark, function, sf_dir)
            note = ""
            if name in oracles:
                types, (sql_columns, sql_rows), sql_took = run_sql(connection, oracles[name])
                if columns != sql_columns:
                    note = f"COLUMNS {columns} != {sql_columns}"
                elif rows != sql_rows:
                    extra = [r for r in rows if r not in set(sql_rows)][:3]
                    lost = [r for r in sql_rows if r not in set(rows)][:3]
                    note = f"VALUES {len(rows)} vs {len(sql_rows)}\n   spark only {extra}\n   sql only   {lost}"
                else:
                    wrong = [
                        f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}" for f in frame.schema
                        if FAMILIES.get(f.dataType.simpleString(), types[f.name]) != types[f.name]
                    ]
                    note = f"ok sql {sql_took:.1f}s" + (f" TYPES {wrong}" if wrong else "")
            else:
                note = "rows only"
            if not rows:
                note += " EMPTY"
            bad += not note.startswith(("ok", "rows"))
            print(f"{name:28s} {took:6.1f}s {len(rows):7d} {note}", flush=True)
        except Exception as error:
            bad += 1
            print(f"{name:28s} ERROR {str(error)[:900]}", flush=True)
            if names:
                traceback.print_exc()
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
