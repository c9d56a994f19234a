"""What the Python side of the near-duplicate join holds at once."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from siltstone.llm import jaccard
from siltstone.llm.shared import U64


class NothingCommon:
    value = np.zeros(0, U64)


def test_entries_of_signatures_are_made_in_bounded_memory():
    rng = random.Random(4)
    names = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    rows = [" ".join(rng.choices(names, k=120)) for _ in range(6000)]
    ids = pa.array(range(len(rows)), pa.int64())
    table = pa.table({"node": ids, "text": rows, "component": ids})
    run = jaccard._entry_blocks(64, NothingCommon)
    list(run(iter(table.slice(0, 10).to_batches())))
    tracemalloc.start()
    try:
        sizes = [b.num_rows for b in run(b for at in range(0, len(rows), 1000) for b in table.slice(at, 1000).to_batches())]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    print(f"{peak / 1e6:.0f} MB, {len(sizes)} blocks")
    assert sum(sizes) and peak < 75e6
