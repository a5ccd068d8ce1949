"""Chat windows: exact round trip, and the budget, history and mask of every window."""

import hashlib
import random

import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skytally.llm import chat_format, queries

PIECES = [*chat_format.CONTROLS, "\\", "<", "[", "/", "s>", "INST]", " ", "\n", "ok", "é", "|role|>"]
SCHEMA = "conv_id long, turn long, role string, text string, block long, window string, split int"


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "a<s>\n"]), st.lists(st.sampled_from(PIECES)).map("".join))))
def test_any_text_is_read_back(turns):
    window = "<s>" + "".join(chat_format.marked(role, text)[0] for role, text in turns)
    assert chat_format.read_back(window) == turns
    for _, text in turns:
        assert chat_format.unescaped(chat_format.escaped(text)) == text
        assert not any(control in chat_format.escaped(text) for control in chat_format.CONTROLS)


def test_other_strings_are_no_windows():
    for text in ("<s>plain", "x", "<s>[INST] open"):
        with pytest.raises(ValueError):
            chat_format.read_back(text)


@pytest.fixture(scope="module")
def tokenizer():
    with open(queries.vocabulary_path(), encoding="utf-8") as file:
        return file.read()


def conversation(seed, turns, system=True, first=0, words=30):
    rng = random.Random(seed)
    roles = (["system"] if system else []) + ["user", "assistant"] * turns
    return [(seed, first + i, role, " ".join(rng.choice(PIECES + ["word"] * 9) for _ in range(rng.randrange(words)))) for i, role in enumerate(roles[:turns])]


ROWS = [
    *conversation(1, 9),
    *conversation(2, 40, system=False),
    *conversation(3, 700, words=8),
    *conversation(4, 300, first=250),
    (5, None, None, None),
    (5, None, "assistant", "a"),
    (5, 3, "assistant", "b"),
    (5, 3, "assistant", "b"),
    (5, 2, "system", "late system"),
    (5, 900, "tool", "[INST]"),
    (None, 0, "user", "x"),
    (None, 1, "assistant", "y " * 5000),
    (None, 2, "user", ""),
    (6, 2**62, "assistant", "far"),
    (6, -(2**62), "system", "near"),
    (7, 0, "system", "only"),
]


def expected(rows):
    found = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, turn, role, text in sorted(rows, key=key):
        found.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in found.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        yield conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def frame(spark, rows):
    full = [(*row, 1, "w", 0) for row in rows]
    return spark.createDataFrame(random.Random(3).sample(full, len(full)), SCHEMA).repartition(5)


def test_digests_of_what_is_read_back(spark, tokenizer):
    made = chat_format.digests(chat_format.formatted(frame(spark, ROWS), tokenizer, budget=200, history=50)).collect()
    assert sorted([tuple(r)[:5] for r in made], key=str) == sorted(expected(ROWS), key=str)


def test_windows_keep_to_the_budget(spark, tokenizer):
    encoder = Tokenizer.from_str(tokenizer)

    def size(role, text):
        return len(encoder.encode(chat_format.marked(role, text)[0], add_special_tokens=False).ids)

    windows = chat_format.formatted(frame(spark, ROWS), tokenizer, budget=200, history=50).collect()
    by_conv = {}
    for w in sorted(windows, key=lambda w: (str(w.conv_id), w.block, w.window)):
        by_conv.setdefault(w.conv_id, []).append(w)
    for conv in (1, 2, 3, 4):
        before, system = [], None
        assert len(by_conv[conv]) > 1
        for w in by_conv[conv]:
            turns = chat_format.read_back(w.formatted)
            repeated, own = turns[: w.repeated], turns[w.repeated :]
            assert own and w.n_tokens == 1 + sum(size(*t) for t in turns)
            assert w.n_tokens <= 200 or len(own) == 1
            if system:
                assert repeated[0] == system
                repeated = repeated[1:]
            # Repeated history is what came right before, and no more of it would fit.
            assert len(repeated) <= chat_format.HISTORY_TURNS and before[len(before) - len(repeated) :] == repeated
            assert sum(size(*t) for t in repeated) <= 50
            targets = [w.formatted[a:b] for a, b in zip(w.loss_starts, w.loss_ends)]
            assert targets == [chat_format.escaped(text) for role, text in own if role == "assistant"]
            system = system or next((t for t in own if t[0] == "system"), None)
            before += [t for t in own if t != system]
    # The whole of a long conversation is cut into blocks; a short one is not.
    assert {w.split for w in by_conv[3]} == {True} and {w.split for w in by_conv[1]} == {False}
    assert len({w.block for w in by_conv[3]}) == 3


def test_a_window_is_as_long_as_the_budget_allows(spark, tokenizer):
    rows = [r for r in ROWS if r[0] == 2]
    windows = chat_format.formatted(frame(spark, rows), tokenizer, budget=200, history=0).collect()
    encoder = Tokenizer.from_str(tokenizer)
    sizes = [len(encoder.encode(chat_format.marked(r[2], r[3])[0], add_special_tokens=False).ids) for r in rows]
    greedy, used = [0], 1
    for n in sizes:
        if greedy[-1] and used + n > 200:
            greedy.append(0)
            used = 1
        greedy[-1] += 1
        used += n
    ordered = sorted(windows, key=lambda w: w.window)
    assert [len(chat_format.read_back(w.formatted)) - w.repeated for w in ordered] == greedy


def test_no_rows(spark, tokenizer):
    assert chat_format.digests(chat_format.formatted(frame(spark, ROWS).limit(0), tokenizer)).count() == 0


def test_the_query_holds_every_conversation(spark):
    made = {r.conv_id: r for r in queries.QUERIES["op12_chat_windows"](spark, SF_DIR).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    assert {tuple(r)[:5] for r in made.values()} == set(expected(rows))
    assert made[-7].loss_chars == 21 and made[-7].formatted_chars > 42
