"""Run a registered query and its oracle side by side.

    python tests/compare.py [--sf DIR] [name-part ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from tidemill.checks import load_all, oracle_text, run  # noqa: E402
from tidemill.checks.harness import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(s: pd.Series) -> str:
    if s.dtype == object or str(s.dtype) in ("str", "string"):
        v = s.dropna()
        return type(v.iloc[0]).__name__ if len(v) else "null"
    return {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time", "m": "span"}.get(s.dtype.kind, str(s.dtype))


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if _kind(df[c]) in ("list", "ndarray"):
            df[c] = df[c].map(lambda x: None if x is None else tuple(np.asarray(x).tolist()))
        if _kind(df[c]) == "time":
            df[c] = df[c].astype("datetime64[us]")
    def text(x):
        if not isinstance(x, (tuple, list)) and pd.isna(x):
            return ""
        return f"{float(x):.6g}" if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)) else str(x)

    key = df.apply(lambda col: col.map(text, na_action=None))
    return df.iloc[key.sort_values(list(key.columns), kind="stable").index if len(df.columns) else []].reset_index(drop=True)


def same(p, q) -> bool:
    if not isinstance(p, (tuple, list)) and not isinstance(q, (tuple, list)) and (pd.isna(p) or pd.isna(q)):
        return bool(pd.isna(p) and pd.isna(q))
    return bool(p == q)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """'' when equal, a message starting with '~' when only the last float digits differ."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = _canon(got.reset_index(drop=True)), _canon(want.reset_index(drop=True))
    note = ""
    for c in got.columns:
        a, b = got[c], want[c]
        ka, kb = _kind(a), _kind(b)
        if ka != kb and "null" not in (ka, kb) and not ({ka, kb} == {"int", "float"} and b.isna().any()):
            note = note or f"~type of {c}: {ka} != {kb}"
        if {ka, kb} <= {"int", "float"}:
            x, y = a.astype(float).to_numpy(), b.astype(float).to_numpy()
            if not np.array_equal(x, y, equal_nan=True):
                if np.allclose(x, y, rtol=1e-9, atol=1e-9, equal_nan=True):
                    note = note or f"~digits of {c}"
                else:
                    i = int(np.argmax(~np.isclose(x, y, rtol=1e-9, atol=1e-9, equal_nan=True)))
                    return f"{c}: {a[i]!r} != {b[i]!r} at {got.iloc[i].to_dict()}"
        else:
            bad = [i for i, (p, q) in enumerate(zip(a, b)) if not same(p, q)]
            if bad:
                return f"{c}: {a[bad[0]]!r} != {b[bad[0]]!r} ({len(bad)} rows) at {got.iloc[bad[0]].to_dict()}"
    return note


def main(argv: list[str]) -> int:
    from tidemill.session import local_session
    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i:i + 2]
    checks = load_all()
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in checks:
        if argv and not any(part in name for part in argv):
            continue
        t0 = time.time()
        try:
            got = run(spark, sf, name).toPandas()
            t1 = time.time()
            sql = oracle_text(name)
            verdict = f"rows-only {len(got)}" if sql is None else compare(got, con.execute(sql).df())
            if sql is not None and not verdict:
                verdict = f"ok {len(got)}"
        except Exception as e:  # noqa: BLE001
            t1 = time.time()
            verdict = "ERROR " + str(e).strip().replace("\n", " ")[:700]
        if not verdict.startswith(("ok", "rows-only")):
            bad += 1
        if verdict in ("ok 0", "rows-only 0"):
            verdict += "   <-- EMPTY"
        print(f"{t1 - t0:6.2f}s {name:36s} {verdict}", flush=True)
    print("not ok:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
