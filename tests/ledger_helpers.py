"""Helpers of the ledger tests: collected rows, comparison with the SQL oracle."""

from __future__ import annotations


def rows(df, *cols, order=None):
    """Collect ``cols`` of ``df`` as a list of tuples (sorted)."""
    out = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t)) if order is None else out


def brute_force_mismatches(spark, ledger, names):
    """Compare Ledger models with the SQL oracle run by DuckDB on the same raw rows."""
    import duckdb
    from compare_oracle import _rows
    from gocledger.plans.oracle import oracle_sql

    con = duckdb.connect()
    for name, df in ledger.raw.items():
        con.register(f"raw_{name}", df.toPandas())
    sqls = oracle_sql(with_binding=False)
    bad = {}
    for name in names:
        sdf = ledger.model(name)
        s_rows = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
        cur = con.execute(sqls[name])
        o_cols = [d[0] for d in cur.description]
        o_rows = _rows(o_cols, cur.fetchall())
        if sorted(sdf.columns) != sorted(o_cols) or s_rows != o_rows:
            bad[name] = (sorted(set(s_rows) - set(o_rows))[:5], sorted(set(o_rows) - set(s_rows))[:5])
    return bad
