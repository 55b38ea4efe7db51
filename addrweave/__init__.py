"""addrweave: conflate a file of address points with an OpenStreetMap snapshot on Spark.

Everything is expressed as DataFrame operations (joins, aggregations, array and
map higher-order functions); the spatial parts use a grid-cell equi-join instead
of a spatial index. See README.md for the operator map.
"""

from addrweave.plans.merge import MergeOptions, MergeResult, merge_addresses

__all__ = ["MergeOptions", "MergeResult", "merge_addresses"]
