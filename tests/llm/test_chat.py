import pytest
from hypothesis import given
from hypothesis import strategies as st

from gridmart.llm import chat

TEXTS = st.lists(st.sampled_from([*chat.CONTROL, "\\", " ", "\n", "a", "[", "</"]), max_size=8).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "</s>"]), TEXTS), max_size=5)
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


@given(TURNS)
def test_output_gives_the_turns_back(turns):
    template = chat.BracketTemplate()
    seen = chat.trace(template, turns)
    assert template.parse(seen.output) == turns
    learned = [(t, seen.output[slice(*p)]) for (r, t), p in zip(turns, seen.texts) if r == "assistant"]
    assert all(template.unescape(held) == text for text, held in learned)
    assert [s for s, _ in seen.spans] == [0, *(e for _, e in seen.spans)][: len(turns)]
    assert seen.rewritten_at == []


def test_template_that_rewrites_history_is_found():
    class LastOnly(chat.BracketTemplate):
        def render(self, turns):
            return "".join(f"{role}:{text if k + 1 == len(turns) else '...'}\n" for k, (role, text) in enumerate(turns))

    seen = chat.trace(LastOnly(), [("user", "hello"), ("assistant", "hi"), ("user", "bye")])
    assert seen.rewritten_at == [1, 2]
    assert seen.texts == [None] * 3


def test_unfinished_output_is_refused():
    with pytest.raises(ValueError):
        chat.BracketTemplate().parse("<s>[INST] a")


def test_rows_in_every_state(spark):
    rows = [
        (1, 1, "assistant", None, "x"),
        (1, 0, "user", "hi", "x"),
        (1, 1, "assistant", None, "x"),
        (None, 0, "user", "a", None),
        (2, None, None, "", None),
        (3, 0, "assistant", "z" * 100_000, None),
    ]
    found = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k: r["n_turns"] for k, r in found.items()} == {1: 3, None: 1, 2: 1, 3: 1}
    assert chat.BracketTemplate().parse(found[1]["formatted"]) == [("user", "hi"), ("assistant", ""), ("assistant", "")]
    assert found[3]["turns"][0]["text_end"] - found[3]["turns"][0]["text_start"] == 100_000
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
