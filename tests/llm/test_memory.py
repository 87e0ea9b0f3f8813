"""What a worker process keeps after its steps."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from pawprint.llm.common import slices


def _megabytes() -> float:
    text = Path("/proc/self/smaps_rollup").read_text()
    return int(re.search(r"\nAnonymous:\s+(\d+)", text).group(1)) / 1024


def test_freed_memory_is_given_back_after_a_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["one text", None, "another"]})
    # Arrays of the heap with small ones between them, which stay and pin it.
    arrays = [np.ones(size) for _ in range(2000) for size in (8000, 100)]
    pinned = arrays[1::2]
    del arrays
    before = _megabytes()
    assert sum(part.num_rows for part in slices([batch])) == 3
    assert _megabytes() < before - 60 and len(pinned) == 2000
