"""A manifest of a table as Merkle trees, one per source and one above them, and each row's way up to the root by a recursive query."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlake.llm.common import checkpointed, shared_folder

FANOUT = 16
# The tree over the subroots; the sources' own trees are numbered from 0.
TOP = -1
# Runs of leaves that meet one copy of a node on their way up; nodes with more runs below them are stored in several copies.
RUNS_A_COPY = 4096
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _hash(value: Column) -> Column:
    return F.sha2(value, 256)


def _written(digests: Column) -> Column:
    """Digests as they enter another digest, as text. They are stored as bytes, half as long."""
    return F.lower(F.hex(digests))


def _joined(digests: Column) -> Column:
    """An array of at most FANOUT digests as one run of bytes."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def leaf_hash(*values: Column) -> Column:
    """Digest of the values, each written as its byte count, a colon and itself, or as a dash if it is null."""
    return _hash(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (v.cast("string") for v in values))))


def lowered(text: Column) -> Column:
    """The tampering: A-Z in lower case, all else as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def due(doc_id: Column) -> Column:
    """Rows that are tampered with: crc32 of the decimal id divides by five. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def positions(rows: DataFrame, group: str, order: list[str], found: Callable[[DataFrame], DataFrame] = lambda starts: starts) -> DataFrame:
    """`rows` with `at`, the place from 0 within the group by the order, for groups of any size.

    Rows are dealt by ranges of (group, order) and numbered where they lie; the groups' shares of every range, a small table, are summed up and added.
    Nothing is numbered in one task. `rows` must be stable (a checkpoint); equal rows are told apart by their place in it. `found` may add columns to
    the small table (`group`, `range`, `n`, `first`, `before`), which all rows of the group then carry.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = checkpointed(dealt.drop("_tie").withColumn("place", F.monotonically_increasing_id()).withColumn("range", F.shiftright("place", 33)))
    starts = placed.groupBy(group, "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    ahead = Window.partitionBy(group).orderBy("range")
    starts = found(checkpointed(starts.withColumn("before", F.sum("n").over(ahead) - F.col("n"))))
    starts = starts.withColumnsRenamed({group: "_group", "range": "_range"})
    both = placed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("range") == F.col("_range")))
    return both.withColumn("at", F.col("place") - F.col("first") + F.col("before")).drop("_group", "_range", "range", "place", "first", "before", "n")


def _sized(starts: DataFrame) -> DataFrame:
    """The small table of ranges with each source's number in byte order (null first), its count of rows, and the number of runs under the node above it."""
    sources = checkpointed(starts.groupBy("source").agg(F.sum("n").alias("size")).withColumn("all", F.lit(0)))
    numbered = positions(sources, "all", ["source"]).select(F.col("source").alias("_source"), F.col("at").alias("tree"), "size")
    beside = F.sum(F.ceil(F.col("size") / FANOUT)).over(Window.partitionBy(F.floor(F.col("tree") / FANOUT)))
    numbered = checkpointed(numbered.withColumn("beside", beside))
    return starts.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


@dataclass
class Manifest:
    """Stored trees. `runs`: the leaves of one parent to a row (`tree`, `at`, `leaves`, where the run's own node lies). `first`: the nodes over runs, level 1
    of the sources' trees. `upper`: all nodes above those, a sixteenth as many
    (`tree`, `level`, `at`, `digest`, `children` digests in one run of bytes (null where they are the leaves of a run), `subroot`, and the parent's `up_tree`, `up_level`, `up_at` with the `slot` there). A node is
    stored in as many copies (`copy`) as RUNS_A_COPY asks for; its children know the number (`up_copies`)."""

    runs: DataFrame
    first: DataFrame
    upper: DataFrame


def _copies(runs: Column) -> Column:
    return F.ceil(runs / RUNS_A_COPY)


def _linked(nodes: DataFrame, level: int, trees: int, top: bool) -> DataFrame:
    """Nodes (`tree`, `at`, `n` nodes on their level of the tree) with the key of their parent: in the tree, in the tree above, or none (root).

    `runs` is the number of runs in a source's tree, or below a node of the tree above.
    """
    inside, below = F.col("n") > 1, F.lit(trees > 1 and not top)
    step = lambda own, above: F.when(inside, own).when(below, above)
    place = step(F.col("at"), F.col("tree"))
    under = F.col("runs") if top else F.least(F.lit(FANOUT ** (level - 1)), "runs")
    above = F.sum("runs").over(Window.partitionBy(F.floor(F.col("at") / FANOUT))) if top else step(F.least(F.lit(FANOUT**level), "runs"), F.col("beside"))
    linked = nodes.withColumns({
        "level": F.lit(level), "subroot": ~inside & F.lit(not top), "up_tree": step(F.col("tree"), F.lit(TOP).cast("long")), "up_level": step(F.lit(level + 1), F.lit(1)),
        "up_at": F.floor(place / FANOUT), "slot": (place % FANOUT).cast("int"), "up_copies": _copies(above), "copies": _copies(under)})
    return linked.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")


def _parents(nodes: DataFrame, top: bool) -> DataFrame:
    """The level above nodes of levels with several nodes; at most FANOUT children meet in one row."""
    runs = nodes.where("n > 1").groupBy("tree", F.floor(F.col("at") / FANOUT).alias("at")).agg(
        F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("run"), F.ceil(F.first("n") / FANOUT).alias("n"), (F.sum if top else F.first)("runs").alias("runs"),
        F.first("beside").alias("beside"))
    children = _joined(F.col("run")["digest"])
    return runs.select("tree", "at", "n", "runs", "beside", children.alias("children"), F.unhex(_hash(_written(children))).alias("digest"))


def build(docs: DataFrame) -> Manifest:
    """Store the trees over `docs` (`doc_id`, `source`, `lang`, `n_chars`, `text`) as Parquet in the shared folder.

    A leaf is a row. Rows of one source come in the order of doc_id, null first; rows of equal id in the order of their digests, so repeated rows have a
    leaf each. Sources come in byte order, null first. Texts are read once; from then on a row is two digests. A level has a sixteenth of the rows below
    it, and the number of levels is the only thing the driver learns besides the number of sources. An empty table has no node.
    """
    spark = docs.sparkSession
    text = docs["text"].cast("string")
    leaf = lambda t: F.unhex(leaf_hash(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"], t))
    rows = checkpointed(docs.select("doc_id", docs["source"].cast("string").alias("source"), leaf(text).alias("leaf"),
                                    F.when(due(docs["doc_id"]), leaf(lowered(text))).alias("tampered")))
    placed = positions(rows, "source", ["doc_id", "leaf"], _sized)
    member = F.struct("at", "doc_id", "leaf", "tampered")
    runs = placed.groupBy("tree", F.floor(F.col("at") / FANOUT).alias("at")).agg(F.sort_array(F.collect_list(member)).alias("leaves"), F.first("size").alias("size"), F.first("beside").alias("beside"))
    folder = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    runs.write.parquet(f"{folder}/runs")
    runs = spark.read.parquet(f"{folder}/runs")
    largest, trees = runs.agg(F.max("size"), F.count_distinct("tree")).first()

    # A source of one row has no level 1: its leaf is its subroot.
    digests = F.col("leaves")["leaf"]
    first = runs.select("tree", "at", F.ceil(F.col("size") / FANOUT).alias("n"), F.ceil(F.col("size") / FANOUT).alias("runs"), "beside", F.lit(None).cast("binary").alias("children"),
                        F.when(F.col("size") > 1, F.unhex(_hash(_written(_joined(digests))))).otherwise(digests[0]).alias("digest"))
    stored = 0

    def store(level: DataFrame, number: int, top: bool) -> DataFrame:
        nonlocal stored
        part = f"{folder}/upper/part={stored}" if stored else f"{folder}/first"
        _linked(level, number, trees, top).write.parquet(part)
        stored += 1
        return spark.read.parquet(part).where("copy = 0")

    def climbed(level: DataFrame, width: int, top: bool) -> list[DataFrame]:
        levels = [store(level, 1, top)]
        while width > 1:
            width = -(-width // FANOUT)
            levels.append(store(_parents(levels[-1], top), len(levels) + 1, top))
        return levels

    levels = climbed(first, -(-(largest or 0) // FANOUT), top=False)
    if trees > 1:
        subroots = [level.where("subroot").select(F.col("tree").alias("at"), "digest", "runs", "beside") for level in levels]
        above = reduce(DataFrame.unionByName, subroots).select(F.lit(TOP).cast("long").alias("tree"), "at", F.lit(trees).cast("long").alias("n"), "digest", "runs", "beside")
        climbed(_parents(above, top=True), -(-trees // FANOUT), top=True)
    lowest = spark.read.parquet(f"{folder}/first")
    return Manifest(runs, lowest, spark.read.parquet(f"{folder}/upper") if stored > 1 else lowest.where("false"))


_CLIMB = """
WITH RECURSIVE climb (tree, at, leaves, folded, above, up_tree, up_level, up_at, up_copies, slot, digest, subroot) AS (
  SELECT r.tree, r.at, r.leaves,
         transform(r.leaves, (l, i) -> CASE WHEN r.size = 1 THEN coalesce(l.tampered, l.leaf) ELSE unhex(sha2(lower(concat(
           array_join(transform(slice(r.leaves.leaf, 1, i), d -> hex(d)), ''), hex(coalesce(l.tampered, l.leaf)),
           array_join(transform(slice(r.leaves.leaf, i + 2, {fanout}), d -> hex(d)), ''))), 256)) END),
         CAST('' AS BINARY), n.up_tree, n.up_level, n.up_at, n.up_copies, n.slot, n.digest, CASE WHEN n.subroot THEN n.digest END
  FROM {runs} r JOIN {first} n ON n.tree = r.tree AND n.at = r.at
  UNION ALL
  SELECT /*+ MERGE(p) */ c.tree, c.at, c.leaves,
         transform(c.folded, f -> unhex(sha2(lower(concat(hex(substring(p.children, 1, 32 * c.slot)), hex(f), hex(substring(p.children, 32 * c.slot + 33)))), 256))),
         concat(c.above, substring(p.children, 1, 32 * c.slot), substring(p.children, 32 * c.slot + 33)),
         p.up_tree, p.up_level, p.up_at, p.up_copies, p.slot, p.digest, coalesce(c.subroot, CASE WHEN p.subroot THEN p.digest END)
  FROM climb c JOIN {upper} p ON p.tree = c.up_tree AND p.level = c.up_level AND p.at = c.up_at AND p.copy = pmod(xxhash64(c.tree, c.at), c.up_copies)
)
SELECT * FROM climb WHERE up_tree IS NULL
"""
_LIMIT = "spark.sql.cteRecursionRowLimit"


def climb(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Every leaf's way up, level by level, with the siblings met on it and the digest folded from the tampered leaf.

    The leaves of one parent share all siblings above it, so they ascend in one row: `folded` holds a digest a leaf, `above` the siblings once for all of
    them. A step joins the parents of one level by key; a node high up, below which many runs meet, is there in copies, so no key grows hot. The
    nodes grow with the rows, so they are merged and not broadcast, alike at every size. The engine's limit on rows of a recursion is lifted while this
    runs; the depth is the height of the trees (16 levels hold 10^19 rows). The result is a checkpoint.
    """
    mark = uuid.uuid4().hex
    names = {name: f"manifest_{name}_{mark}" for name in ("runs", "first", "upper")}
    for name, view in names.items():
        getattr(manifest, name).createOrReplaceTempView(view)
    before = spark.conf.get(_LIMIT)
    spark.conf.set(_LIMIT, -1)
    try:
        return checkpointed(spark.sql(_CLIMB.format(fanout=FANOUT, **names)))
    finally:
        spark.conf.set(_LIMIT, before)
        for name in names.values():
            spark.catalog.dropTempView(name)


def proofs(climbed: DataFrame) -> DataFrame:
    """One row per leaf: its digest, those of its source and of the whole, the siblings (`proof`, hex digests from the leaf up, left to right in a run),
    the root folded from the tampered leaf, and whether it is the true one."""
    rows = climbed.select(F.posexplode("leaves").alias("i", "l"), "leaves", "folded", "above", "digest", "subroot")
    digests, i = F.col("leaves")["leaf"], F.col("i")
    proof = F.concat(_joined(F.slice(digests, F.lit(1), i)), _joined(F.slice(digests, i + 2, F.lit(FANOUT))), F.col("above"))
    folded, root = F.col("folded")[i], F.col("digest")
    return rows.select("l.doc_id", _written(F.col("l.leaf")).alias("leaf"), _written(F.col("subroot")).alias("subroot"), _written(root).alias("root"), _written(proof).alias("proof"),
                       _written(folded).alias("folded_root"), (folded == root).alias("verified"))


def digest(docs: DataFrame) -> DataFrame:
    """A row per row of `docs`, repeated ones included, with its proof as a digest. Null ids and texts are values of their own and are not tampered with;
    texts of any length are only hashed; extra columns are not part of a leaf; an empty table gives no row."""
    found = proofs(climb(docs.sparkSession, build(docs)))
    return found.select("doc_id", "leaf", "subroot", "root", _hash(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")
