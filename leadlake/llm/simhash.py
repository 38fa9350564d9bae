"""SimHash near-duplicates: 64-bit fingerprints, sharded by a vantage-point tree over Hamming distance, linked and joined into components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import checkpointed, text_of

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
# The tree's vantage points and radii come from a bounded sample; every fingerprint is then placed by it.
SAMPLE_ROWS = 65_536
LEAF_ROWS = 4_096
_QUERY_BLOCK = 512


def fingerprint(text: str) -> int:
    """The fingerprint of a text as an unsigned number; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(b"%b %b %b" % s, seed) for s in zip(words, words[1:], words[2:])], "<u8")
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp): a signed 64-bit number for every row. Null, empty and blank texts have fingerprint 0."""
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))

    return docs.select("doc_id", F.xxhash64(text_of(docs)).alias("text_hash"), of(text_of(docs)).alias("fp"))


@dataclass
class Node:
    """A vantage point: fingerprints nearer than `radius` are inside, the others outside. A leaf has a number and no point."""

    leaf: int = -1
    point: np.uint64 = np.uint64(0)
    radius: int = 0
    inside: Node | None = None
    outside: Node | None = None


def apart(a: np.ndarray, b: np.uint64 | np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def build_tree(sample: np.ndarray, leaves: int) -> Node:
    """Split a sample at median distances until about `leaves` shards remain; points that cannot be told apart stay in one shard."""
    chosen = np.random.default_rng(SEED)
    numbered = iter(range(1 << 30))

    def split(points: np.ndarray, wanted: int) -> Node:
        if wanted > 1 and len(points) > 1:
            point = points[chosen.integers(len(points))]
            far = apart(points, point)
            radius = int(np.median(far))
            inner = far < radius
            if 0 < inner.sum() < len(points):
                return Node(point=point, radius=radius, inside=split(points[inner], -(-wanted // 2)), outside=split(points[~inner], wanted // 2))
        return Node(leaf=next(numbered))

    return split(np.sort(sample), leaves)


def place(tree: Node, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, home): each fingerprint's home shard, and the shards it visits because a partner could live there.

    A home row crosses a boundary from inside to outside only, since the partner on the other side need not cross too; visitors go wherever the
    triangle bound leaves room for a home row within RADIUS.
    """
    out: list[tuple[np.ndarray, int, bool]] = []

    def walk(node: Node, home: np.ndarray, visit: np.ndarray) -> None:
        if not len(home) + len(visit):
            return
        if node.leaf >= 0:
            out.extend((rows, node.leaf, kind) for rows, kind in ((home, True), (visit, False)) if len(rows))
            return
        near, far = apart(fps[home], node.point), apart(fps[visit], node.point)
        walk(node.inside, home[near < node.radius], visit[far < node.radius + RADIUS])
        crossing = home[(near < node.radius) & (near >= node.radius - RADIUS)]
        walk(node.outside, home[near >= node.radius], np.concatenate((visit[far >= node.radius - RADIUS], crossing)))

    walk(tree, np.arange(len(fps)), np.empty(0, np.int64))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool)
    return (np.concatenate([r for r, _, _ in out]), np.concatenate([np.full(len(r), leaf, np.int32) for r, leaf, _ in out]),
            np.concatenate([np.full(len(r), kind) for r, _, kind in out]))


def linked(home: np.ndarray, visit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, roots, links) over home and then visiting rows of a shard: one root for all rows that links join, and each row's number of partners.

    Rows are put in order of their distance to one point, so a row meets only those whose distance differs by RADIUS at most.
    """
    fps = np.concatenate((home, visit))
    parent, links = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    if len(home):
        point = home[0]
        order = np.argsort(apart(home, point), kind="stable")
        ring = apart(home, point)[order]
        own = apart(fps, point)
        queries = np.argsort(own, kind="stable")
        for at in range(0, len(queries), _QUERY_BLOCK):
            rows = queries[at : at + _QUERY_BLOCK]
            low, high = np.searchsorted(ring, own[rows[0]] - RADIUS), np.searchsorted(ring, own[rows[-1]] + RADIUS, "right")
            for part in range(low, high, 1 << 14):
                against = order[part : min(high, part + (1 << 14))]
                q, h = np.nonzero(np.bitwise_count(fps[rows][:, None] ^ home[against][None, :]) <= RADIUS)
                q, h = rows[q], against[h]
                q, h = q[q != h], h[q != h]
                np.add.at(links, q, 1)
                np.add.at(links, h, q >= len(home))
                pairs = np.unique(np.stack((parent[q], parent[h]), axis=1), axis=0) if len(q) else np.empty((0, 2), np.int64)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                if len(pairs):
                    for a, b in pairs.tolist():
                        while parent[a] != a:
                            a = parent[a]
                        while parent[b] != b:
                            b = parent[b]
                        parent[max(a, b)] = min(a, b)
                    while (parent[parent] != parent).any():
                        parent = parent[parent]
    rows = np.flatnonzero(links)
    return rows, parent[rows], links[rows]


def link_edges(distinct: DataFrame) -> DataFrame:
    """(fp, root): for distinct fingerprints `fp`, edges that connect all those within RADIUS bits, never all pairs of a dense group."""
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE_ROWS).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = build_tree(sample, max(1, -(-total // LEAF_ROWS)))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            rows, leaf, home = place(tree, fps.view(np.uint64))
            yield pd.DataFrame({"leaf": leaf, "fp": fps[rows], "home": home})

    def joined(shard: pd.DataFrame) -> pd.DataFrame:
        fps, home = shard["fp"].to_numpy(np.int64), shard["home"].to_numpy(bool)
        fps = np.concatenate((np.sort(fps[home]), np.sort(fps[~home])))
        n = int(home.sum())
        rows, roots, _ = linked(fps[:n].view(np.uint64), fps[n:].view(np.uint64))
        apart_rows = rows != roots
        return pd.DataFrame({"fp": fps[rows[apart_rows]], "root": fps[roots[apart_rows]]})

    shards = distinct.mapInPandas(placed, "leaf int, fp long, home boolean")
    return shards.groupBy("leaf").applyInPandas(joined, "fp long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(fp, component): the smallest fingerprint reachable over edges (fp, root), for every end of an edge.

    Each round hooks every neighbour to the smallest one around a node, first the larger neighbours and then the smaller; stars remain.
    Rounds end when the edges no longer change. Each is a reliable checkpoint.
    """
    now = checkpointed(edges.select(F.greatest("fp", "root").alias("u"), F.least("fp", "root").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(smallest, "u")
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
        now = checkpointed(small)
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("fp"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("fp"), F.col("v").alias("component"))).distinct()


def group_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, group, component_id) for every row: its group's smallest fingerprint and smallest doc_id.

    Equal fingerprints are one node from the start, so copies cost nothing further. Rows without text share fingerprint 0 and one group.
    Null ids take part but are never the smallest unless a group has no other; repeated rows each keep a result. An empty table gives no rows.
    """
    found = checkpointed(fingerprints(docs))
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("first"))
    merged = components(link_edges(distinct.select("fp")))
    roots = distinct.join(merged, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("group"))
    smallest = roots.groupBy("group").agg(F.min("first").alias("component_id"))
    return found.join(roots.join(smallest, "group").select("fp", "group", "component_id"), "fp")


def digest(docs: DataFrame) -> DataFrame:
    return group_documents(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of `docs` for each group: that of the smallest doc_id, null ids last; of rows with the same id and text, the smallest by content.

    Columns stay as they are.
    """
    names = docs.columns
    plain = docs.withColumnsRenamed({c: f"in_{i}" for i, c in enumerate(names)})
    own = {c: F.col(f"in_{names.index(c)}") for c in ("doc_id", "text")}
    chosen = group_documents(docs).groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("_first"))
    hashed = plain.withColumns({"_id": own["doc_id"], "_hash": F.xxhash64(F.coalesce(own["text"].cast("string"), F.lit("")))})
    first = chosen.select("_first.doc_id", "_first.text_hash")
    stay = hashed.join(first, hashed["_id"].eqNullSafe(first["doc_id"]) & (hashed["_hash"] == first["text_hash"]), "left_semi")
    row = F.struct(*(F.col(f"in_{i}") for i in range(len(names))))
    one = stay.groupBy("_id", "_hash").agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return one.select(*(F.col("_row")[f"in_{i}"].alias(c) for i, c in enumerate(names)))
