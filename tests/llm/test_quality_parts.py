"""Statistics measured a few texts at a time."""

import numpy as np
import pyarrow as pa

from opsloom.llm import quality


def test_statistics_of_parts(monkeypatch):
    texts = ["One two.\nThree", None, "", "a b " * 40, "ÄÖ xx!", "line | line\n" * 9] * 3
    whole = quality.statistics(pa.array(texts))
    sizes = []
    real = quality._measured
    monkeypatch.setattr(quality, "_measured", lambda column: sizes.append(len(column)) or real(column))
    monkeypatch.setattr(quality, "PART_BYTES", 64)
    assert np.array_equal(whole, quality.statistics(pa.array(texts)))
    assert len(sizes) > 3 and sum(sizes) == len(texts)
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.STATISTICS))
