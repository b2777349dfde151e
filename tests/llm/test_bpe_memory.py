"""A worker's tokenizer holds no second vocabulary until a text needs it, and a bounded number of words."""

from __future__ import annotations

import numpy as np
import tokenizers

from medloom.llm import bpe
from medloom.llm.queries import vocabulary_path


def test_library_waits_for_rarer_scripts(monkeypatch):
    t = bpe.Tokenizer(vocabulary_path())
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    monkeypatch.setattr(bpe, "MOST_WORDS", 40)

    def same(text):
        return np.frombuffer(t.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

    assert all(same(" ".join(f"word{i * 7 % 90} und{i % 50}" for i in range(k, k + 60))) for k in range(0, 600, 60))
    assert len(t.words) + len(t.words.old) <= 80
    assert "library" not in vars(t)
    assert same("ภาษาไทย العربية word1")
    assert "library" in vars(t)
