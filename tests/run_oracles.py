"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from oracle_check import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from parley.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, orc = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        if name not in orc:
            try:
                n = fn(spark, sf).count()
                print(f"{name:40s} ROWS-ONLY n={n} {time.time()-t:.1f}s")
            except Exception:
                bad += 1
                print(f"{name:40s} ERROR\n{traceback.format_exc()[-2000:]}")
            continue
        try:
            probs, ns, nd = compare(spark, name, fn, orc[name], sf)
            status = "OK" if not probs else "MISMATCH " + "; ".join(probs)
            bad += bool(probs)
            print(f"{name:40s} {status[:1500]} rows={ns}/{nd} {time.time()-t:.1f}s")
        except Exception:
            bad += 1
            print(f"{name:40s} ERROR\n{traceback.format_exc()[-2000:]}")
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
