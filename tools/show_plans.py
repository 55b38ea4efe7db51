"""Print the physical plan shape of each pass as Spark would plan it with no small side.

Usage: python tools/show_plans.py [sf_dir]
AQE and automatic broadcasts are switched off so the static plan shows the
shuffles a large run pays (at runtime AQE may still coalesce, split skewed
partitions or switch a join to broadcast from measured sizes).
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import DataFrame  # noqa: E402

from addrweave.operators import match as M  # noqa: E402
from addrweave.operators.local import local_features  # noqa: E402
from addrweave.plans.catalog import BOUNDS, context  # noqa: E402
from addrweave.session import local_session, scratch_path  # noqa: E402
from addrweave.sources.area import parse_wkt_area  # noqa: E402
from addrweave.sources.fixtures import load_fixtures  # noqa: E402

OPS = ("SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Exchange hashpartitioning",
       "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "Generate", "FileScan parquet")


def shape(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in plan.splitlines():
        for op in OPS:
            if op in line:
                indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
                text = line.strip(" :+-*")
                text = re.sub(r"\(\d+\) ", "", text)
                if op == "FileScan parquet":
                    m = re.search(r"FileScan parquet \[([^\]]*)\]", text)
                    text = "Scan [" + (m.group(1)[:80] if m else "") + "]"
                    pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
                    if pf and pf.group(1):
                        text += " PushedFilters[" + pf.group(1)[:80] + "]"
                elif op.startswith("Exchange"):
                    m = re.search(r"hashpartitioning\((.*), \d+\)", line)
                    text = "Exchange " + re.sub(r"#\d+L?", "", m.group(1) if m else "")[:80]
                else:
                    text = op + ("  " + re.sub(r"#\d+L?", "", text[len(op):].split("functions=")[0])[:100] if "Join" in op or "Aggregate" in op else "")
                lines.append(" " * indent + text)
                break
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    ctx = context(spark, sf_dir)
    local = local_features(load_fixtures(spark, sf_dir).snapshot, parse_wkt_area(BOUNDS), matchable=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept: list[tuple[str, DataFrame]] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        """Written and read back as in a merge; the plan of what is written is shown."""
        kept.append((f"C4 {name} (written)", df))
        df.write.parquet(path := scratch_path(spark, name))
        return spark.read.parquet(path)

    coded = M.building_matches(ctx.pool, ctx.local_all, 0.5, 10.0, keep=keep)
    for name, df in (
        ("C1 nodes of the local table (P1)", local.nodes),
        ("C1 ways of the local table (P2; those that can match)", local.ways),
        ("C1 multipolygon lines that can match (J1, A1)", local.multipolygons),
        ("J2 exact duplicates (semi-join on number, street, city)", M.exact_duplicates(ctx.imports, ctx.local_all)),
        ("C3 no-city pass with D3", M.nocity_matches(ctx.pool, ctx.local_all, 5.0)),
        *kept,
        ("C4 building pass, as coded, from the written candidates", coded),
    ):
        print(f"=== {name}\n{shape(df)}\n")
    spark.stop()


if __name__ == "__main__":
    main()
