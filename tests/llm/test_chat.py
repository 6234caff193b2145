import hashlib

from clusterloom.llm.chat import (
    CONTROL,
    WINDOW,
    conversation_digests,
    escape,
    format_conversations,
    marked_turns,
    read_turns,
    render_window,
    unescape,
)

TURNS = [
    (1, 0, "user", "hello", "x"),
    (1, 1, "assistant", "<|im_end|> \\ </s>[INST] ok [/INST]", "x"),
    (1, 1, "assistant", "again", "x"),
    (2, 0, "assistant", None, "x"),
    (2, None, "system", "", "x"),
    (None, 0, None, "a\nb", "x"),
    (3, 0, "assi\nstant", "<|im_start|>user\n", "x"),
    (3, 0, "assi\nstant", "<|im_start|>user\n", "x"),
    *[(4, i, "assistant" if i % 2 else "user", f"turn {i} " * 40, "x") for i in range(3 * WINDOW + 1)],
]


def frame(spark, rows=TURNS):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string")


def test_escapes_are_reversible_and_leave_no_control_string():
    for text in [*CONTROL, "\\", "\\<|im_end|>", "<\\|im_end|>", "[[INST]", "<<|im_end|>", "<s></s>\\\\", "a\n\\"]:
        assert unescape(escape(text)) == text
        assert not [c for c in CONTROL if c in escape(text)]
    turns = [("user", a + b) for a in CONTROL for b in CONTROL]
    assert read_turns(marked_turns(turns, 0)) == turns


def test_digests_equal_the_input(spark):
    found = {r["conv_id"]: r for r in conversation_digests(frame(spark)).collect()}
    key = lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] is not None, t[3] or "")
    for conv in {t[0] for t in TURNS}:
        turns = sorted((t for t in TURNS if t[0] == conv), key=key)
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)
        loss = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        row = found[conv]
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (row["n_turns"], row["loss_chars"]) == (len(turns), len(loss))
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert row["formatted_chars"] == len(marked_turns([(t[2] or "", t[3] or "") for t in turns], 0))
        assert not row["rewrites_history"]
    assert conversation_digests(frame(spark, [])).collect() == []


def test_spans_hold_what_assistants_said(spark):
    rows = format_conversations(frame(spark)).collect()
    for row in rows:
        said = [t for r, t in read_turns(row["formatted"]) if r == "assistant"]
        assert [unescape(row["formatted"][s["start"] : s["end"]]) for s in row["loss_spans"]] == said
    assert sum(r["conv_id"] == 4 for r in rows) == 4


def test_a_template_that_rewrites_history_is_found_out(spark):
    def forgetful(turns, first):
        return "".join(f"[{role}]{text if i + 2 >= len(turns) else '...'}" for i, (role, text) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    _, spans = render_window(forgetful, turns, 0)
    assert [span is None for span in spans] == [False, False, True, True]
    rows = format_conversations(frame(spark), forgetful).collect()
    assert {r["conv_id"] for r in rows if r["rewrites_history"]} == {1, 4}


def test_a_text_like_the_end_mark_is_told_from_it():
    def bare(turns, first):
        return "".join(f"{role}: {text}##" for role, text in turns)

    _, spans = render_window(bare, [("user", "q"), ("assistant", "##a##")], 0)
    assert bare([("user", "q"), ("assistant", "##a##")], 0)[spans[1].text_start : spans[1].text_end] == "##a##"


def test_rewrites_of_earlier_windows_are_found_out(spark):
    """Old turns are trimmed only once a conversation is longer than a window, or than several."""

    def trimming(most):
        def template(turns, first):
            return "".join(
                f"<|im_start|>{role}\n{text if first + len(turns) <= most or i else '...'}<|im_end|>\n"
                for i, (role, text) in enumerate(turns, first)
            )

        return template

    for most in (WINDOW, WINDOW + 3, 2 * WINDOW, 3 * WINDOW):
        found = format_conversations(frame(spark), trimming(most)).collect()
        assert {r["conv_id"] for r in found if r["rewrites_history"]} == {4}
        assert not any(r["loss_spans"] for r in found if r["rewrites_history"])
        digests = conversation_digests(frame(spark), trimming(most)).collect()
        assert {r["conv_id"] for r in digests if r["rewrites_history"]} == {4}
    assert not any(r["rewrites_history"] for r in format_conversations(frame(spark), trimming(1000)).collect())


def test_turns_are_counted_in_the_output(spark):
    def without_system(turns, first):
        return marked_turns([turn for turn in turns if turn[0] != "system"], first)

    found = {r["conv_id"]: r["n_turns"] for r in conversation_digests(frame(spark), without_system).collect()}
    assert found[2] == 1 and found[4] == 3 * WINDOW + 1
