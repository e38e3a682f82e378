"""All registered queries."""

from siftgate.workload import case_queries, check_queries, page_queries, run_queries, stream_queries, verdict_queries
from siftgate.workload.case_queries import flagship
from siftgate.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "flagship"]
