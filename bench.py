"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is run into the no-op sink, so every result row is computed and none is kept. The
best of two runs counts, after a warm-up that starts the JVM code and the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbline.plans import QUERIES  # noqa: E402
from kerbline.session import local_session  # noqa: E402

HEADLINE = (
    "hero_per_property", "nearest_asof", "pose_interpolation", "pose_stats", "voxel_first", "diagnosis_matrix",
    "sessionize", "decimate_bursts", "visibility_pairs", "voxel_mean", "motion_audit_imu", "deskew",
    "loop_candidates", "thermal_anomalies", "trajectory_gate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("kerbline-bench", cpus=cpus)
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for warm in ("voxel_first", "trajectory_gate"):
        run(warm)
    took = {name: round(min(run(name), run(name)), 3) for name in names}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
