"""Importance resampling over pieces of a batch: a piece must give what its texts give by themselves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from medloom.llm import resample


def test_features_of_a_slice():
    texts = ["" if i % 97 == 0 else f"Wort{i} été the CAT-{i % 13} sat " * (i % 40) for i in range(6000)]
    batch = pa.record_batch([pa.array(texts)], ["text"])
    for at, n in ((0, 1500), (1500, 2500), (4000, 2000)):
        cut = resample.Features(batch.slice(at, n).column("text"), 1000, 2)
        fresh = resample.Features(pa.array(texts[at : at + n]), 1000, 2)
        assert cut.words.tolist() == fresh.words.tolist() == [6 * (i % 40) if i % 97 else 0 for i in range(at, at + n)]
        assert np.array_equal(cut.counts(1000), fresh.counts(1000))
        assert np.array_equal(cut.sums(np.arange(1000)), fresh.sums(np.arange(1000)))
