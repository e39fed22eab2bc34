"""What a task of the near-duplicate operator holds is bounded, and its links don't depend on it."""

import numpy as np
import pyarrow as pa
import pytest

from palimpsest.llm import neardup as N


def group() -> pa.Table:
    """One probe and three members of other components, two of them near the probe, under one signature."""
    words = [f"w{i}" for i in range(80)]
    texts = [" ".join(words), " ".join(words[:-1] + ["x"]), " ".join(words[:-1] + ["y"]), " ".join(f"z{i}" for i in range(80))]
    node = [bytes([i]) * 16 for i in range(4)]
    sig = np.ones(N.M, "<u2").tobytes()
    return pa.table({"key": pa.array([0] * 4, pa.int64()), "lot": pa.array([0] * 4, pa.int32()), "block": pa.array([0] * 4, pa.int32()),
                     "probe": [True, False, False, False], "node": node, "label": node, "apart": [True, False, False, False],
                     "sig": [sig] * 4, "text": texts})


@pytest.mark.parametrize("held", [0, N.HELD])
def test_links_do_not_depend_on_what_is_held(monkeypatch, held):
    monkeypatch.setattr(N, "HELD", held)
    most, read = [0], N.shingles
    monkeypatch.setattr(N, "shingles", lambda *a: most.__setitem__(0, most[0] + 1) or read(*a))
    t = group()
    got = N._cross_links(t, np.zeros(1, np.int64), N.THRESHOLD)
    assert {frozenset(p) for p in zip(got["a"], got["b"], strict=True)} == {frozenset((bytes(16), bytes([i]) * 16)) for i in (1, 2)}
    assert most[0] == 4 if held else most[0] > 4  # texts are read again once let go
