"""Common prefixes compare many symbols at once."""

import numpy as np

from leadlake.llm import suffix_dedup


class Counted(np.ndarray):
    reads = 0

    def __getitem__(self, at):
        Counted.reads += 1
        return super().__getitem__(at)


def test_symbols_are_not_compared_one_by_one():
    data = np.concatenate((np.tile(np.arange(37), 22), [900], np.tile(np.arange(37), 22), [901]))
    order = suffix_dedup.suffix_array(data)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:].tolist())
    common = suffix_dedup.common_prefixes(data.view(Counted), order, np.array([0]), np.array([len(data)]))
    assert Counted.reads < 20
    for i in range(1, len(order)):
        a, b = data[order[i - 1]:], data[order[i]:]
        n = min(len(a), len(b), suffix_dedup.SPAN_BYTES)
        same = a[:n] == b[:n]
        assert common[i] == (n if same.all() else int(np.argmin(same)))
