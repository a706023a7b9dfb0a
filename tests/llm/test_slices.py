"""Work on a batch of texts takes memory by the slice, not by the batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from viewlens.llm import fm_quality, line_rules
from viewlens.llm.common import slices


@pytest.fixture(scope="module")
def batch():
    rng = random.Random(3)
    words = [f"word{i}" for i in range(5000)]
    texts = ["\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(40)) for _ in range(2000)]
    return pa.RecordBatch.from_pydict({"text": pa.array(texts), "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_slices_hold_every_row_once(batch):
    parts = list(slices(batch))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 4
    one = pa.RecordBatch.from_pydict({"text": pa.array(["x" * (3 << 20), None, "y"])})
    assert [p.num_rows for p in slices(one)] == [1, 2]
    assert list(slices(batch.slice(0, 0))) == []


@pytest.mark.parametrize("name", ["held lines", "cleaned texts", "scores"])
def test_memory_of_a_batch(batch, name):
    n = fm_quality.BUCKETS + fm_quality.N_STATS
    model = (0.0, np.zeros(n, np.float32), np.zeros((n, 8), np.float32), np.zeros(n, np.float32))
    work = {
        "held lines": lambda: sum(b.num_rows for b in line_rules._held_lines([batch])),
        "cleaned texts": lambda: [len(line_rules.measure(p.column("text"))[1]) for p in slices(batch)],
        "scores": lambda: [len(fm_quality._scored(p, model)) for p in slices(batch, limit=fm_quality.SLICE_BYTES, rows=fm_quality.SLICE_ROWS)],
    }[name]
    assert batch.nbytes > 7e6
    assert peak_mb(work) < 50
