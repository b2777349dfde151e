"""The language model is trained on every document unless a share is asked for."""

from __future__ import annotations

import numpy as np

from medloom.llm import lm


def test_every_document_trains(spark):
    docs = spark.createDataFrame([(i, f"one{i % 7} two{i % 5} three four{i % 3} five " * 20) for i in range(80)], "doc_id long, text string")
    docs = docs.coalesce(1).sortWithinPartitions("doc_id")
    of, _ = lm.classes(lm.word_counts(docs))
    assert np.array_equal(lm.train(docs, of), lm.train(docs, of, share=1.0))
    # a word that one document holds moves the parameters, whichever document that is
    base = lm.train(docs, of, rounds=1)
    for i in (3, 40, 77):
        less = lm.train(docs.where(f"doc_id <> {i}"), of, rounds=1)
        assert not np.array_equal(base, less)
