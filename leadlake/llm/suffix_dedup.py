"""Removal of long byte strings that occur more than once anywhere, decided by suffix arrays over the places that can repeat.

Every string of SPAN_BYTES that occurs twice holds the same anchor: the position, among those it covers, whose short hash is smallest. Strings that start
one after another and share an anchor form a block. Blocks meet by a hash of bytes that all their strings hold, so a string and its copies always meet,
and text that repeats nowhere meets nothing and is never sorted. Blocks equal in full are settled by counting. The rest are settled per shard: a suffix
array by Larsson and Sadakane's refinement, common prefixes by Kasai's walk, and, for keys cut over parts of a shard, binary search between the parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import checkpointed, text_of

SPAN_BYTES = 400
ANCHOR_BYTES = 32
# Strings of a block start at most this many bytes apart; the rest of SPAN_BYTES is common to them and makes their key.
BLOCK_STARTS = 185
CORE_BYTES = SPAN_BYTES - BLOCK_STARTS + 1
_REACH = SPAN_BYTES - ANCHOR_BYTES + 1
# Bytes hashed at once (or one text, if longer), bytes of one suffix array, bytes of a shard, and the most different blocks of one key that are sorted: keys beyond it
# are settled string by string, in Spark.
CHUNK_BYTES = 1 << 21
# Anchors are chosen in pieces of so many starts, since a place within a piece shares a 64-bit number with its hash and has _PLACE_BITS of it.
PIECE_STARTS, _PLACE_BITS = 1 << 22, 26
PART_BYTES = 1 << 20
SHARD_BYTES = 4 << 20
WIDE_KEY_BLOCKS = 4_096


class _Hashes:
    """64-bit hashes of any byte range, equal for equal bytes: weighted sums of one random number per byte value, from running sums."""

    def __init__(self, seed: int):
        chosen = np.random.default_rng(seed)
        self._values = chosen.integers(0, 1 << 64, 256, np.uint64)
        self._base = int(chosen.integers(0, 1 << 62)) * 8 + 5
        self._back = pow(self._base, -1, 1 << 64)
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _raised(self, factor: int, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, factor, np.uint64), dtype=np.uint64)))

    def read(self, data: np.ndarray) -> _Hashes:
        if len(self._powers) <= len(data):
            self._powers, self._inverses = self._raised(self._base, len(data)), self._raised(self._back, len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._values[data] * self._inverses[: len(data)], out=self._sums[1:])
        return self

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._powers[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self._sums) - size
        return mixed((self._sums[size:] - self._sums[:n]) * self._powers[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _anchors(short: np.ndarray) -> np.ndarray:
    """For each start the leftmost position of the smallest of the _REACH short hashes from there on."""
    n = len(short)
    if n - _REACH + 1 > PIECE_STARTS:
        return np.concatenate([_anchors(short[a : a + PIECE_STARTS + _REACH - 1]) + a for a in range(0, n - _REACH + 1, PIECE_STARTS)])
    rows = -(-n // _REACH)
    low = np.full(rows * _REACH, np.uint64(0xFFFFFFFFFFFFFFFF))
    low[:n] = (short & ~np.uint64((1 << _PLACE_BITS) - 1)) | np.arange(n, dtype=np.uint64)
    table = low.reshape(rows, _REACH)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[: n - _REACH + 1], ahead[_REACH - 1 : n]) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)


def _blocks_of(data: np.ndarray, ends: np.ndarray, first: _Hashes, second: _Hashes) -> tuple[np.ndarray, ...]:
    """(document, key, body, lo, hi) of the blocks of documents laid end to end: `lo` to `hi` are the starts of a block's strings."""
    none = (np.empty(0, np.int64),) * 5
    if len(data) < SPAN_BYTES:
        return none
    first.read(data), second.read(data)
    anchor = _anchors(first.every(ANCHOR_BYTES))
    start = np.arange(len(anchor))
    document = np.searchsorted(ends, start, "right")
    whole = start + SPAN_BYTES <= ends[np.minimum(document, len(ends) - 1)]
    start, anchor, document = start[whole], anchor[whole], document[whole]
    if not len(start):
        return none
    level = (anchor - start) // BLOCK_STARTS
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(level) != 0) | (np.diff(start) != 1) | (np.diff(document) != 0)) + 1
    low, high = np.concatenate(([0], new)), np.concatenate((new, [len(start)])) - 1
    lo, hi, at, level, document = start[low], start[high], anchor[low], level[low], document[low]
    core = at - level * BLOCK_STARTS
    key = mixed(first.of(core, core + CORE_BYTES) + level.astype(np.uint64))
    body = mixed(second.of(lo, hi + SPAN_BYTES) ^ mixed(((at - lo) * 1024 + (at - hi)).astype(np.uint64)))
    return document, key.view(np.int64), body.view(np.int64), lo, hi


def blocks(texts: DataFrame) -> DataFrame:
    """(key, body, doc_id, text_hash, lo, n): the blocks of every text; `lo` is the first start, `n` the number of starts after it."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, second = _Hashes(11), _Hashes(23)
        for batch in batches:
            raw = [t.encode("utf-8") for t in batch["text"]]
            sizes = np.array([len(r) for r in raw], np.int64)
            group = np.cumsum(sizes) // CHUNK_BYTES
            for g in np.unique(group):
                rows = np.flatnonzero(group == g)
                ends = np.cumsum(sizes[rows])
                data = np.frombuffer(b"".join(raw[r] for r in rows), np.uint8)
                document, key, body, lo, hi = _blocks_of(data, ends, first, second)
                own = rows[document]
                yield pd.DataFrame({"key": key, "body": body, "doc_id": batch["doc_id"].array.take(own), "text_hash": batch["text_hash"].to_numpy()[own],
                                    "lo": lo - (ends - sizes[rows])[document], "n": hi - lo})

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.where(F.octet_length("text") >= SPAN_BYTES).mapInPandas(cut, f"key long, body long, doc_id {kind}, text_hash long, lo int, n short")


def _packed(data: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(numbers, bits, length): for each position, and the end, its next `length` symbols in one number of `bits` bits each; zeros follow the end."""
    bits = int(data.max(initial=0) + 1).bit_length()
    length = max(1, 62 // bits)
    numbers = np.zeros(len(data) + 1, np.int64)
    padded = np.concatenate((data + 1, np.zeros(length, np.int64)))
    for i in range(length):
        numbers[:] = numbers << bits | padded[i : i + len(numbers)]
    return numbers, bits, length


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions of an integer string in the order of their suffixes.

    Larsson and Sadakane: all positions are ordered by as many first symbols as one number holds, then, doubling the length each round, only groups
    still equal are ordered by the rank of the position half a length further on.
    """
    n = len(data)
    first, _, length = _packed(data)
    first = first[:n]
    order = np.argsort(first)
    rank = np.empty(n, np.int64)
    rank[order] = np.searchsorted(first[order], first[order])
    while True:
        ranked = rank[order]
        tied = np.concatenate(([False], ranked[1:] == ranked[:-1]))
        rows = np.flatnonzero(tied | np.concatenate((tied[1:], [False])))
        if not len(rows):
            return order
        at = order[rows]
        ahead = at + length
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        both = rank[at] * (n + 1) + second
        turn = np.argsort(both)
        at, both = at[turn], both[turn]
        order[rows] = at
        new = np.concatenate(([True], np.diff(both) != 0))
        rank[at] = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
        length *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each place in a suffix array the prefix common to its suffix and the one before, up to SPAN_BYTES.

    Kasai's walk through the string, one step of all bodies (`starts`, `sizes`) at a time: from a position to the next a prefix loses one symbol at most,
    so what was matched is not read again. Symbols are compared as many at once as one number holds.
    """
    numbers, bits, length = _packed(data)
    before = np.full(len(data), -1, np.int64)
    before[order[1:]] = order[:-1]
    common = np.zeros(len(data), np.int64)
    held = np.zeros(len(starts), np.int64)
    for step in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > step)
        at = starts[live] + step
        other = before[at]
        h = np.where(other >= 0, np.maximum(held[live] - 1, 0), 0)
        going = np.flatnonzero((other >= 0) & (h < SPAN_BYTES))
        while len(going):
            differ = numbers[at[going] + h[going]] ^ numbers[other[going] + h[going]]
            some = differ >> (bits * (length - 1)) == 0
            going, differ = going[some], differ[some]
            same = np.ones(len(going), np.int64)
            for left in range(length - 1):
                same += differ >> (bits * left) == 0
            h[going] += same
            going = going[(same == length) & (h[going] < SPAN_BYTES)]
        held[live] = common[at] = np.minimum(h, SPAN_BYTES)
    return common[order]


def repeated_starts(bodies: list[bytes]) -> list[np.ndarray]:
    """For each body which of its starts begin a string of SPAN_BYTES that begins elsewhere in these bodies too, by one suffix array."""
    lengths = np.array([len(b) for b in bodies], np.int64)
    ends = np.cumsum(lengths + 1)
    starts, sizes = ends - lengths - 1, lengths - SPAN_BYTES + 1
    data = np.frombuffer(b"\0".join([*bodies, b""]), np.uint8).astype(np.int64) + len(bodies)
    data[ends - 1] = np.arange(len(bodies))  # one closing symbol for each body, so no match runs over it
    order = suffix_array(data)
    common = common_prefixes(data, order, starts, lengths)
    is_start = np.zeros(len(data) + 1, np.int64)
    is_start[starts] += 1
    is_start[starts + sizes] -= 1
    places = np.flatnonzero(np.cumsum(is_start)[order])
    twice = np.zeros(len(data), bool)
    if len(places) > 1:
        same = np.minimum.reduceat(common, places[:-1] + 1)[: len(places) - 1]
        same[-1] = common[places[-2] + 1 : places[-1] + 1].min()
        met = same >= SPAN_BYTES
        twice[order[places[1:][met]]] = True
        twice[order[places[:-1][met]]] = True
    return [twice[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist())]


def _windows(body: bytes) -> np.ndarray:
    """All strings of SPAN_BYTES of a body, as fixed-size values that sort bytewise."""
    table = np.lib.stride_tricks.sliding_window_view(np.frombuffer(body, np.uint8), SPAN_BYTES)
    return np.ascontiguousarray(table).view(f"S{SPAN_BYTES}").ravel()


def settle(keys: np.ndarray, bodies: list[bytes]) -> list[np.ndarray]:
    """`repeated_starts` of a shard sorted by key, in parts of PART_BYTES; a key cut by parts is merged by binary search in the earlier ones' sorted strings."""
    part = np.cumsum([len(b) for b in bodies]) // PART_BYTES
    found: list[np.ndarray] = [None] * len(bodies)
    for p in np.unique(part):
        rows = np.flatnonzero(part == p)
        for r, twice in zip(rows, repeated_starts([bodies[r] for r in rows])):
            found[r] = twice.copy()
    for key in {k for a, b, k in zip(part, part[1:], keys[1:]) if a != b}:
        rows = np.flatnonzero(keys == key)
        parts = [rows[part[rows] == p] for p in np.unique(part[rows])]
        for i, later in enumerate(parts):
            for earlier in parts[:i]:
                known = np.concatenate([_windows(bodies[r]) for r in earlier])
                by_order = np.argsort(known, kind="stable")
                known, hit = known[by_order], np.zeros(len(known), bool)
                for r in later:
                    own = _windows(bodies[r])
                    left, right = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
                    found[r] |= right > left
                    for a, b in zip(left[right > left], right[right > left]):
                        hit[by_order[a:b]] = True
                at = 0
                for r in earlier:
                    found[r] |= hit[at : at + len(found[r])]
                    at += len(found[r])
    return found


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())


def _sorted_shards(sliced: DataFrame, shards: int, kind: str) -> DataFrame:
    """(doc_id, text_hash, lo, hi): repeated starts of the open blocks, shard by shard."""
    def of(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["key", "body"], kind="stable")
        out = []
        for (doc, text, lo, c), twice in zip(shard[["doc_id", "text_hash", "lo", "copies"]].itertuples(index=False), settle(shard["key"].to_numpy(), list(shard["bytes"]))):
            if c == 1:
                out += [(doc, text, lo + a, lo + b) for a, b in _runs(twice)]
        return pd.DataFrame(out, columns=["doc_id", "text_hash", "lo", "hi"])

    return sliced.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInPandas(of, f"doc_id {kind}, text_hash long, lo int, hi int")


def _wide_keys(sliced: DataFrame) -> DataFrame:
    """(doc_id, text_hash, lo, hi) for keys of very many different blocks: their strings are counted one by one, by two hashes, over the whole cluster."""
    each = sliced.select("doc_id", "text_hash", "lo", "copies", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - SPAN_BYTES)).alias("k"))
    string = F.substring(F.col("bytes"), F.col("k") + 1, F.lit(SPAN_BYTES))
    hashed = each.select("doc_id", "text_hash", (F.col("lo") + F.col("k")).alias("lo"), "copies", F.md5(string).alias("string"))
    often = hashed.groupBy("string").agg(F.sum("copies").alias("n")).where("n > 1").select("string")
    return hashed.where("copies = 1").join(often, "string", "left_semi").select("doc_id", "text_hash", "lo", F.col("lo").alias("hi"))


_ROW = ["_no_id", "_id", "text_hash"]


def _by_row(rows: DataFrame) -> DataFrame:
    """`rows` with the columns _ROW, none of them null: joined and grouped by plain equality, rows keep one partitioning and are not shuffled again."""
    absent = F.lit(0).cast(rows.schema["doc_id"].dataType)
    return rows.withColumns({"_no_id": F.col("doc_id").isNull(), "_id": F.coalesce("doc_id", absent)})


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, lo, hi): ranges of starts, in bytes, of strings of SPAN_BYTES that start elsewhere too."""
    texts = docs.select("doc_id", text_of(docs).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    cut = blocks(texts)
    alike = checkpointed(cut.groupBy("key", "body").agg(F.count("*").alias("copies")))
    of_key = alike.groupBy("key").agg(F.sum("copies").alias("rows"), F.count("*").alias("bodies")).where("rows > 1")
    shared = checkpointed(cut.join(alike.join(of_key, "key"), ["key", "body"]))
    settled = shared.where("copies > 1").select("doc_id", "text_hash", "lo", (F.col("lo") + F.col("n")).alias("hi"))

    open_ = shared.where("bodies > 1")
    total = open_.agg(F.sum((F.col("n") + SPAN_BYTES) / F.col("copies"))).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))
    one = open_.groupBy("key", "body", "copies", "bodies").agg(F.min(F.struct("doc_id", "text_hash", "lo", "n")).alias("at"))
    wanted = _by_row(one.select("at.*", "key", "body", "copies", "bodies")).groupBy(*_ROW).agg(F.collect_list(F.struct("key", "body", "copies", "bodies", "lo", "n")).alias("parts"))
    near = _by_row(texts).join(wanted, _ROW).dropDuplicates(_ROW)
    part = F.explode("parts").alias("p")
    sliced = near.select("doc_id", "text_hash", F.encode("text", "UTF-8").alias("raw"), part).select(
        "doc_id", "text_hash", "p.key", "p.body", "p.copies", "p.bodies", "p.lo", F.substring(F.col("raw"), F.col("p.lo") + 1, F.col("p.n") + SPAN_BYTES).alias("bytes"))
    return settled.unionByName(_sorted_shards(sliced.where(F.col("bodies") <= WIDE_KEY_BLOCKS), shards, kind)).unionByName(_wide_keys(sliced.where(F.col("bodies") > WIDE_KEY_BLOCKS)))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """For every row of `docs`: doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes).

    Bytes covered by a repeated string go, wherever its copies are, first ones included, judged on the input. Null and empty texts have no bytes; texts
    shorter than SPAN_BYTES lose nothing. Repeated rows repeat each other, so they lose their text from SPAN_BYTES on. Rows are told apart by id and text.
    """
    texts = docs.select("doc_id", text_of(docs).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    ranges = _by_row(repeated(docs)).groupBy(*_ROW).agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    joined = _by_row(texts).join(ranges, _ROW, "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch["text"], batch["ranges"]):
                raw = text.encode("utf-8")
                kept, at, spans = [], 0, 0
                for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges) if ranges is not None else ():
                    if lo > at or not spans:
                        kept.append(raw[at:lo])
                        spans += 1
                    at = max(at, hi + SPAN_BYTES)
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), spans, kept))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"]).assign(doc_id=batch["doc_id"].array)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "ranges").mapInPandas(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
