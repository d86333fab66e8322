"""Named queries over the bundled tables."""

from kerbline.plans import visibility_queries, time_queries, quality_queries, point_queries, imaging_queries, sequential_queries, live_queries  # noqa: F401, I001
from kerbline.plans.registry import QUERIES  # noqa: F401
