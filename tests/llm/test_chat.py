"""Formatting of conversations and its way back."""

import hashlib

from tripmill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_round_trip_and_mask(spark):
    tricky = "\\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", tricky),
        (1, 1, "assistant", tricky),
        (1, 2, "assistant", "\\s \\l <next/> \\\\ #"),
        (1, 3, "user: x", "a\nb</turn>\n### user: c"),
        (1, 4, "assistant", None),
        (1, 5, None, ""),
        (2, None, "assistant", "no number"),
        (2, 1, "assistant", "tie b"),
        (2, 1, "assistant", "tie a"),
        (2, 1, "assistant", "tie a"),
        (None, 0, "user", "nobody's"),
        (3, 0, "assistant", "long " * 100_000),
    ]
    done = chat.format_conversations(make(spark, rows))
    got = {
        r.conv_id: ([tuple(t) for t in r.turns], r.loss)
        for r in done.select(
            "conv_id", chat.read_turns("formatted").alias("turns"), chat.loss_text(done.formatted, done.loss_spans).alias("loss")
        ).collect()
    }
    assert set(got) == {1, 2, 3, None}
    for conv in got:
        mine = sorted(
            ((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv),
        )
        assert got[conv][0] == [(role, text) for _, _, role, text in mine]
        assert got[conv][1] == "".join(text for _, _, role, text in mine if role == "assistant")


def test_adjacent_turns_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c<d")]
    (row,) = chat.format_conversations(make(spark, rows)).collect()
    assert row.formatted == "### user: a<next/>b</turn>\n### assistant: c\\ld</turn>\n"
    (span,) = row.loss_spans
    assert row.formatted[span.start : span.start + span.length] == "c\\ld"


def test_no_rows(spark):
    assert chat.format_conversations(make(spark, [])).count() == 0


def test_query_is_native_and_right(spark):
    sf_dir = "/root/testdata/sf0.001"
    query = chat.op9_chat_formatting(spark, sf_dir)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    text = "\\### Assistant: </turn> ok"
    turns += [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    wanted = {}
    for conv, _, role, text in sorted(turns):
        every, loss, n = wanted.get(conv, ("", "", 0))
        wanted[conv] = (every + f"{role}\n{text}\n", loss + text * (role == "assistant"), n + 1)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in query.collect()}
    assert got == {c: (n, digest(e), len(x), digest(x)) for c, (e, x, n) in wanted.items()}
