"""Long conversations are formatted by the same rule as short ones."""

from __future__ import annotations

import pytest

from medloom.llm import chat


def test_turns_may_depend_on_their_place_at_every_length(spark):
    numbered = lambda messages: "".join(f"{n}: {chat.turn_template([m])}" for n, m in enumerate(messages))
    recent = lambda messages: chat.turn_template(messages[-300:])
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"text # {t}") for t in range(600)]
    turns += [(2, t, "user", "x" * 90_000) for t in range(40)]  # prefixes of more than 4 M characters
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    for template in (numbered, chat.turn_template):
        rows = sorted(chat.render(frame, template).collect(), key=lambda r: (r["conv_id"], r["turn_no"]))
        for key in (1, 2):
            whole = template([(r[2], r[3]) for r in turns if r[0] == key])
            own = [r for r in rows if r["conv_id"] == key]
            assert "".join(r["piece"] for r in own) == whole
            assert [chat.unescape(whole[r["text_start"] : r["text_end"]]) for r in own] == [r[3] for r in turns if r[0] == key]
    with pytest.raises(Exception, match="longer prefix changes"):
        chat.render(frame, recent).collect()
