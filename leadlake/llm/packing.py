"""Packing token pieces into sequences: a configuration program over the histogram of lengths, by multiplicative weights and knapsack pricing."""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import checkpointed, text_of

LENGTH = 2048
END_ID = 0
# Rounds of pricing in a solve, how fast a size's weight rises as it lags behind the others, how far below the best price a configuration may lie, the share
# of what a size still lacks that one configuration covers in a round, and the share of all pieces below which the rest is no longer solved for.
ROUNDS = 40
RATE = 1.0
NEAR_BEST = 0.005
SHARE = 0.5
REST = 0.01
# Below this share of a size's pieces it counts as covered.
COVERED = 0.01
# Rows of one length that are numbered in one task.
ROWS_A_BUCKET = 50_000
_CACHE_WORDS = 400_000

# The vocabulary's own rule for cutting text, with letters spelled out for texts that hold no others; other texts take the library's general rule.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[^\\x00-\\x7f{_LETTERS}]")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \\t-\\r{_LETTERS}0-9]+|[ \\t-\\r]+(?![^ \\t-\\r])|[ \\t-\\r]+")


def load_encoder(ranks_path: str | None = None) -> Callable[[str], bytes]:
    """A function from text to its ids as little-endian unsigned 32-bit numbers. `ranks_path` names the vocabulary's file of ranks."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = lambda text: np.array(encoding.encode_ordinary(text), "<u4").tobytes()

    class Known(dict):
        def __missing__(self, piece: str) -> bytes:
            if len(self) >= _CACHE_WORDS:
                self.clear()
            self[piece] = found = ids(piece)
            return found

    known = Known()
    return lambda text: ids(text) if _PLAIN.search(text) else b"".join(map(known.__getitem__, _PIECES.findall(text)))


def token_pieces(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and END_ID, cut into pieces of LENGTH; only the first may be shorter.

    Null and empty texts are the one id END_ID. Every row gives its own pieces, also for repeated ids.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = load_encoder(ranks_path), END_ID.to_bytes(4, "little")
        for batch in batches:
            out = []
            for row, text in enumerate(batch["text"]):
                ids = encode(text) + end
                first = (len(ids) // 4 - 1) % LENGTH + 1
                bounds = [0, *range(first, len(ids) // 4 + 1, LENGTH)]
                out += [(row, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            found = pd.DataFrame(out, columns=["row", "piece", "start", "length", "ids_crc32"])
            found["doc_id"] = batch["doc_id"].array.take(found["row"].to_numpy())
            yield found[["doc_id", "piece", "start", "length", "ids_crc32"]]

    rows = docs.select(F.col("doc_id").cast("string"), text_of(docs).alias("text"))
    kind = docs.schema["doc_id"].dataType
    return rows.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long").withColumn("doc_id", F.col("doc_id").cast(kind))


@dataclass
class Plan:
    """Where the n-th piece of a length goes: slots by length, and the number of sequences."""

    slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    sequences: int


def _price(sizes: np.ndarray, worth: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total worth of pieces that fit each capacity, and the size last added there (0: none), by dynamic programming."""
    best, last = np.zeros(limit + 1), np.zeros(limit + 1, np.int64)
    for room in range(1, limit + 1):
        fit = np.searchsorted(sizes, room, "right")
        if fit:
            value = worth[:fit] + best[room - sizes[:fit]]
            at = int(value.argmax())
            if value[at] > best[room - 1]:
                best[room], last[room] = value[at], sizes[at]
                continue
        best[room] = best[room - 1]
    return best, last


def best_fit(counts: dict[int, int], limit: int = LENGTH) -> list[tuple[dict[int, int], int]]:
    """Largest sizes first, each into the sequences with the least room that holds it; alike sequences are handled together."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []

    def put(inside: dict[int, int], often: int, room: int) -> None:
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append((inside, often))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left > 0:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                inside, often = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, inside, often = limit, {}, left
            times = room // size
            full = min(often, left // times)
            if full:
                put({**inside, size: times}, full, room - times * size)
            left -= full * times
            if full < often and 0 < left < times:
                put({**inside, size: left}, 1, room - left * size)
                full, left = full + 1, 0
            if full < often and inside:
                put(inside, often - full, room)
    return [group for groups in open_.values() for group in groups]


def fractions(counts: dict[int, int], limit: int = LENGTH) -> dict[tuple[tuple[int, int], ...], float]:
    """How much of each configuration ((size, times), ...) covers the histogram with few sequences: the program without whole numbers.

    Each round weighs the sizes by what they still lack against the mean, prices all configurations by the knapsack over these weights, and adds to
    those near the best price, one for each size, a share of what their scarcest size lacks. No size is covered beyond its count.
    """
    sizes = np.array(sorted(counts))
    asked = np.array([counts[s] for s in sizes.tolist()], float)
    place, lack = {s: i for i, s in enumerate(sizes.tolist())}, asked.copy()
    used: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(ROUNDS):
        live = lack > COVERED * asked
        if not live.any():
            break
        mean = (lack * sizes).sum() / (asked * sizes).sum()
        weight = np.exp(RATE * np.clip(lack / asked / mean - 1, -2, 2))
        open_, worth = sizes[live], (sizes * weight)[live]
        best, last = _price(open_, worth, limit)
        near = np.flatnonzero(worth + best[limit - open_] >= (1 - NEAR_BEST) * best[limit])
        for size in open_[near][::-1].tolist():
            inside, room = Counter({size: 1}), limit - size
            while room > 0:
                if last[room]:
                    inside[int(last[room])] += 1
                room -= int(last[room]) or 1
            if all(n <= asked[place[s]] for s, n in inside.items()):
                step = SHARE * min(lack[place[s]] / n for s, n in inside.items())
                key = tuple(sorted(inside.items()))
                used[key] = used.get(key, 0.0) + step
                for s, n in inside.items():
                    lack[place[s]] -= step * n
    return used


def programmed(counts: dict[int, int], limit: int = LENGTH) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """(configurations with how often each is used, what is left of the histogram): at most REST of all pieces, or pieces too few for any
    near-best configuration, as in tables of some dozens.

    The fractions are rounded, the largest first and each to one at least, as far as pieces are left; the program is then solved anew for the rest.
    """
    left, chosen, enough = dict(counts), [], REST * sum(counts.values())
    while sum(left.values()) > enough:
        before = len(chosen)
        for inside, amount in sorted(fractions(left, limit).items(), key=lambda u: (-u[1], u[0])):
            often = min(max(1, int(amount + 0.5)), *(left.get(s, 0) // n for s, n in inside))
            if often:
                chosen.append((dict(inside), often))
                for s, n in inside:
                    left[s] -= n * often
        left = {s: n for s, n in left.items() if n}
        if len(chosen) == before:
            break
    return chosen, left


def configurations(counts: dict[int, int], limit: int = LENGTH) -> list[tuple[dict[int, int], int]]:
    """Configurations {size: times} with how often each is used, so that every piece is in exactly one: those of the program, and best fit for its small rest.

    Each solve takes at most ROUNDS rounds over at most `limit` sizes and leaves a part of its pieces to the next, so the work grows with the logarithm of
    their number.
    """
    if not counts:
        return []
    chosen, left = programmed(counts, limit)
    return chosen + best_fit(left, limit)


def plan_sequences(counts: dict[int, int], limit: int = LENGTH) -> Plan:
    """The configurations of a histogram, written as slots: (first rank, first sequence, times a sequence, offset) by size."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {size: [] for size in counts}
    taken, sequences = dict.fromkeys(counts, 0), 0
    for inside, often in configurations(counts, limit):
        offset = 0
        for size, n in sorted(inside.items(), reverse=True):
            rows[size].append((taken[size], sequences, n, offset))
            taken[size] += n * often
            offset += n * size
        sequences += often
    return Plan({size: tuple(np.array(x, np.int64).reshape(-1, 4).T) for size, x in rows.items()}, sequences)


def pack(pieces: DataFrame) -> DataFrame:
    """`pieces` (with `doc_id`, `piece`, `start`, `length`) and each one's `sequence_id` and `offset`, gapless from 0 in every sequence.

    Pieces of one length are alike to the plan, so they are only numbered: by buckets of a hash, as many as the commonest length needs, and by running
    sums over the buckets' counts. The histogram (at most LENGTH rows) goes to the driver, the plan to the tasks; both are bounded by LENGTH, ROUNDS and the
    number of solves.
    """
    spark = pieces.sparkSession
    pieces = checkpointed(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = -(-max(counts.values(), default=1) // ROWS_A_BUCKET)
    plan = spark.sparkContext.broadcast(plan_sequences(counts).slots)

    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    ahead = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
             .withColumn("ahead", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).drop("n"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(order) - 1).join(ahead, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("ahead"))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = plan.value
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length, rows in batch.groupby("length").indices.items():
                first, base, times, at = slots[length]
                rank = batch["rank"].to_numpy()[rows]
                slot = np.searchsorted(first, rank, "right") - 1
                nth = rank - first[slot]
                sequence[rows], offset[rows] = base[slot] + nth // times[slot], at[slot] + nth % times[slot] * length
            yield batch.drop(columns=["rank"]).assign(sequence_id=sequence, offset=offset)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in columns)
    return ranked.select(*columns, "rank").mapInPandas(placed, f"{types}, sequence_id long, offset long")


def digest(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """All pieces of `docs` with their places. Null and empty texts are a piece of one id; texts of any length are cut, never shortened; repeated rows and null ids
    have pieces of their own; equal lengths are dealt by a hash of the piece; extra columns are not read; an empty table gives no row."""
    return pack(token_pieces(docs, ranks_path))
