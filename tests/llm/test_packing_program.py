"""The configuration program places nearly all pieces itself, in nearly as few sequences as the lengths allow."""

import duckdb
import pytest

from leadlake.llm import packing


def histogram(times):
    """Lengths of pieces of the documents of sf0.1, at about three bytes an id, every count `times` over."""
    sizes = duckdb.sql("SELECT CAST(strlen(coalesce(text, '')) / 3 AS BIGINT) + 1 FROM '/root/testdata/sf0.1/documents.parquet'").fetchall()
    counts = {}
    for (n,) in sizes:
        full, first = divmod(n - 1, packing.LENGTH)
        counts[first + 1] = counts.get(first + 1, 0) + times
        if full:
            counts[packing.LENGTH] = counts.get(packing.LENGTH, 0) + full * times
    return counts


@pytest.mark.parametrize("times", [1, 1000])
def test_program_places_the_pieces(times):
    counts = histogram(times)
    chosen, left = packing.programmed(counts)
    assert sum(left.values()) <= 0.05 * sum(counts.values())
    used = packing.configurations(counts)
    placed = {}
    for inside, often in used:
        assert often > 0 and sum(s * n for s, n in inside.items()) <= packing.LENGTH
        for s, n in inside.items():
            placed[s] = placed.get(s, 0) + n * often
    assert placed == counts
    bound = -(-sum(s * n for s, n in counts.items()) // packing.LENGTH)
    assert sum(often for _, often in used) <= bound * 1.001 + 1
