"""The whole merge.

Key constraints (D6) are checked on the way and stop the merge. With ``materialize``, the clipped ways, the local
table, the import pool, the picks of all passes (ids and distances) and the resolved matches with their payload are written while
the merge is called; change sets are projections of the resolved matches (those of relations, which meet the member
table, are written once too). All outputs are lazy DataFrames over these tables, which ``MergeResult.close`` deletes. Row
counts of tables that are written anyway are observed on the way.

imports --J2--> duplicates / remaining_after_duplicates
        --J3..J5 (no-city)-->  \
        --J7..J11 (buildings)-->  matches --D5--> change sets (C5)
remaining = remaining_after_duplicates minus matched imports (U2, J12)

The passes do not exclude each other (one import may change a node, a way, a
relation and a building), so they are independent branches joined only by U2.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from addrweave.operators.changes import Changes, change_sets
from addrweave.operators.checks import assert_valid, check_imports, check_local_keys, check_matches, is_broken
from addrweave.operators.local import Local, local_features
from addrweave.operators.match import (
    AS_CODED,
    MATCH_COLUMNS,
    PICK_COLUMNS,
    building_assignments,
    building_hits,
    conflict_groups,
    exact_duplicates,
    nocity_picks,
    remaining_after_duplicates,
    resolve_conflicts,
    with_payload,
)
from addrweave.operators.spatial_join import FEW_IDS, by_merge
from addrweave.session import remove_scratch, scratch_path, side_by_side
from addrweave.sources.area import Area, parse_wkt_area
from addrweave.sources.snapshot import Snapshot, load_imports


@dataclass
class MergeOptions:
    """Options of the merge (distances in metres)."""

    buffer: float = 0.5
    nocity: float | None = None
    building: float | None = None
    strip_keys: Sequence[str] = field(default_factory=list)
    semantics: str = AS_CODED
    conflicts: str = "error"  # error | nearest | report
    materialize: bool = True  # write local features and the import pool to the checkpoint folder
    sorted_output: bool = False  # O2: remaining imports in file order (their ``position``), else by import_id
    strict: bool = True  # D6: stop on rows that break a key constraint


class MergeResult:
    """Outputs of one merge; the change sets and the summary are built on first access."""

    def __init__(self, imports, snapshot, strip_keys, local, duplicates, pool, matches, conflicts, remaining, check, written, scratch, counts, unique):
        self._check = check
        self._written = written
        self._scratch = scratch
        self._counts = counts  # n_imports and n_pool, if they were seen on the way
        self._unique = unique  # import ids are known to be unique
        self._imports = imports
        self._snapshot = snapshot
        self._strip_keys = strip_keys
        self.local: Local | None = local  # None when local_all was passed in
        self.duplicates: DataFrame = duplicates
        self.remaining_after_duplicates: DataFrame = pool
        self.matches: DataFrame = matches  # resolved matches of all passes: import_id, type, id, dist, tags, pass
        self.conflicts: DataFrame = conflicts  # D5 report (before resolution)
        self.remaining: DataFrame = remaining

    @cached_property
    def changes(self) -> Changes:
        def check() -> None:
            if self._check:
                assert_valid(check_matches(self.matches))

        made = change_sets(self.matches, self._snapshot.relation_members, self._strip_keys)
        _, relations = side_by_side(check, lambda: self._written(made.relations, "changed_relations"))
        return Changes(made.nodes, made.ways, relations)

    def close(self) -> None:
        """Delete the tables that the merge wrote; its DataFrames can't be used afterwards."""
        spark = self._imports.sparkSession
        while self._scratch:
            remove_scratch(spark, self._scratch.pop())

    @cached_property
    def summary(self) -> DataFrame:
        remaining = None if self._unique else self.remaining
        return merge_summary(self._imports, self.remaining_after_duplicates, self.matches, self.changes, remaining, **self._counts)


def empty_picks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "import_id int, type string, id bigint, dist double, pass string")


def merge_addresses(
    spark: SparkSession,
    imports: DataFrame,
    snapshot: Snapshot,
    area: Area | str,
    options: MergeOptions | None = None,
    local_all: DataFrame | None = None,
    pool: DataFrame | None = None,
) -> MergeResult:
    """Run the merge (see the module's notes on what runs at once).

    ``local_all`` / ``pool`` may be passed in when they were already built (and
    written) for this snapshot, area and import file.
    """
    opt = options or MergeOptions()
    if isinstance(area, str):
        area = parse_wkt_area(area)
    scratch: list[str] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        """Cut lineage by writing a table into the shared checkpoint folder and reading it back."""
        if not opt.materialize:
            return df
        path = scratch_path(spark, name)
        scratch.append(path)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)  # no job to look the schema up

    imports = load_imports(imports)
    keep = written if opt.materialize else None

    def check_keys() -> None:
        if opt.strict and is_broken(imports, ["import_id"], F.col("import_id").isNull() | F.col("lon").isNull() | F.col("lat").isNull()):
            assert_valid(check_imports(imports))

    def build_local() -> Local:
        return local_features(snapshot, area, matchable=True, keep=keep)

    local = None
    if local_all is None:
        _, local = side_by_side(check_keys, build_local)
        local_all = local.all
    else:
        check_keys()

    dups = exact_duplicates(imports, local_all)
    counts: dict[str, int] = {}

    def check_local() -> None:
        if opt.strict:
            assert_valid(check_local_keys(local_all))

    def build_pool() -> DataFrame:
        seen, left = Observation("imports"), Observation("pool")
        count = F.count(F.lit(1)).alias("n")
        made = written(remaining_after_duplicates(imports.observe(seen, count), local_all).observe(left, count), "import_pool")
        if opt.materialize and imports.isEmpty():  # a plan that is found empty while it runs loses what it observes
            counts.update(n_imports=0, n_pool=0)
        elif opt.materialize:
            counts.update(n_imports=seen.get["n"], n_pool=left.get["n"])
        return made

    if pool is None:
        _, pool = side_by_side(check_local, build_pool)
    else:
        check_local()

    # the passes do not depend on each other; of each match they write ids and distance
    def nocity_pass() -> DataFrame:
        return written(nocity_picks(pool, local_all, opt.nocity, opt.semantics, keep).select(*PICK_COLUMNS), "nocity_picks")

    def building_pass() -> DataFrame:
        hits = building_hits(pool, local_all, opt.buffer, opt.building, opt.semantics, keep)
        return written(building_assignments(hits, opt.semantics).select(*PICK_COLUMNS), "building_picks")

    passes = [p for p, wanted in ((nocity_pass, opt.nocity), (building_pass, opt.building)) if wanted is not None]
    raw = empty_picks(spark)
    for picks in side_by_side(*passes) if passes else []:
        raw = raw.unionByName(picks)

    conflicts = conflict_groups(raw)
    matches = resolve_conflicts(raw, opt.conflicts) if passes else raw
    if passes and opt.materialize and raw.count() <= FEW_IDS:
        matches = F.broadcast(matches)
    matches = with_payload(matches, pool, local_all).select(*MATCH_COLUMNS)
    if passes:
        matches = written(matches, "matches")

    matched_ids = matches.select("import_id").distinct()
    remaining = pool.join(by_merge(matched_ids), "import_id", "left_anti")
    if opt.sorted_output:
        remaining = remaining.orderBy("position" if "position" in remaining.columns else "import_id")
    check = opt.strict and opt.conflicts != "report"  # a report leaves objects with several changes in
    return MergeResult(imports, snapshot, opt.strip_keys, local, dups, pool, matches, conflicts, remaining, check, written, scratch, counts, opt.strict)


def merge_summary(
    imports: DataFrame,
    pool: DataFrame,
    matches: DataFrame,
    changes: Changes,
    remaining: DataFrame | None = None,
    n_imports: int | None = None,
    n_pool: int | None = None,
) -> DataFrame:
    """A3: one row per stage with its row count (``stage``, ``n``).

    Duplicates are the imports that left the pool, and (if import ids are unique and ``remaining`` is not given) imports remain
    unless they are matched, so a count of imports, one of the pool (both can be given) and one pass over the ids of the
    matches tell all but the changed relations."""

    def figures(df: DataFrame, **named) -> DataFrame:
        return df.agg(*(c.cast("bigint").alias(name) for name, c in named.items()))

    def known(df: DataFrame, name: str, n: int | None) -> DataFrame:
        return figures(df, **{name: F.count(F.lit(1))}) if n is None else df.sparkSession.range(1).select(F.lit(n).cast("bigint").alias(name))

    of = {f"changed_{name}": F.count_if(F.col("type") == code) for name, code in (("nodes", "N"), ("ways", "W"))}
    ids = matches.groupBy("import_id").agg(*(c.alias(name) for name, c in of.items()))
    matched = figures(ids, matched_imports=F.count(F.lit(1)), **{name: F.coalesce(F.sum(name), F.lit(0)) for name in of})
    one = known(imports, "imports", n_imports)
    for other in (known(pool, "remaining_after_duplicates", n_pool), matched, figures(changes.relations, changed_relations=F.count(F.lit(1)))):
        one = one.select("*", *(other.select(c).scalar().alias(c) for c in other.columns))
    one = one.withColumn("duplicates", F.col("imports") - F.col("remaining_after_duplicates"))
    left = F.col("remaining_after_duplicates") - F.col("matched_imports")
    one = one.withColumn("remaining", left if remaining is None else figures(remaining, n=F.count(F.lit(1))).scalar())
    return one.unpivot([], [F.col(c) for c in STAGES], "stage", "n")


STAGES = [
    "imports", "duplicates", "remaining_after_duplicates", "matched_imports", "changed_nodes", "changed_ways", "changed_relations", "remaining",
]


def write_outputs(result: MergeResult, out_dir: str, single_file: bool = False, keep_scratch: bool = False) -> None:
    """Write every output of a merge: remaining imports (OSM XML, K1), the change file
    (osmChange XML, K5), the change tables (Parquet, K6) and the summary (Parquet, A3); then delete
    the merge's own tables unless ``keep_scratch``."""
    from addrweave.sinks.osm_xml import write_changes_parquet, write_osc, write_osm

    write_osm(result.remaining, f"{out_dir}/remaining.osm", single_file=single_file)
    write_osc(result.changes, f"{out_dir}/changes.osc", single_file=single_file)
    write_changes_parquet(result.changes, f"{out_dir}/changes")
    result.summary.write.mode("overwrite").parquet(f"{out_dir}/summary")
    if not keep_scratch:
        result.close()
