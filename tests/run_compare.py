"""Command line: compare all or some queries at one scale."""

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
from compare import compare, connect  # noqa: E402

from kerbline.plans import QUERIES  # noqa: E402
from kerbline.session import local_session  # noqa: E402

folder = sys.argv[1]
names = sys.argv[2:] or list(QUERIES)
spark = local_session()
con = connect(folder)
bad = 0
for name in names:
    start = time.time()
    try:
        q = QUERIES[name]
        if q.sql is None:
            n = q(spark, folder).count()
            out = None if n else "no rows"
            tag = f"rows only ({n})"
        else:
            out, tag = compare(q, spark, folder, con), "ok"
    except Exception as e:  # report and go on
        out = f"{type(e).__name__}: {str(e)[:1500]}"
    took = time.time() - start
    bad += out is not None
    print(f"{name:32s} {took:6.2f}s {tag if out is None else 'DIFF ' + out}", flush=True)
print("bad:", bad)
