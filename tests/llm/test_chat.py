import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from loomstar.llm import chat

PARTS = st.lists(st.sampled_from(["\\", "n\\", "\n", "a", "<", "s>", *chat.CONTROL]), max_size=8).map("".join)


@settings(max_examples=500, deadline=None)
@given(PARTS, PARTS)
def test_texts_come_back_and_hold_no_control_string(role, text):
    formatted, start, length = chat.render(role, text)
    assert chat.read_back(formatted) == (role, text)
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    if role in chat.TRAINED:
        assert chat.unescape(formatted[start : start + length]) == text


EVENTS = [
    (1, 0, 0, "message", "user", "hi"),
    (1, 1, 3, "delta", "assistant", " there"), (1, 1, 2, "message", "assistant", "hello"),
    (1, 2, 4, "message", "user", "typo"), (1, 2, 5, "edit", "user", "fixed"),
    (1, 3, 6, "message", "assistant", "bad"), (1, 3, 7, "regenerate", "assistant", None),
    (1, 3, 8, "delta", "assistant", "good "), (1, 3, 9, "delta", "assistant", "one"),
    (1, 4, 10, "message", "user", "gone"), (1, 4, 11, "delete", "user", None),
    (2, None, None, "message", None, None), (None, 0, 0, "message", "user", "x"), (None, 0, 0, "message", "user", "x"),
    (3, 0, 0, "delta", "assistant", "a"), (3, 0, 1, None, "assistant", "b"),
]
SCHEMA = "conv_id long, message long, seq long, kind string, role string, text string"


def test_events_fold_into_final_messages(spark):
    log = spark.createDataFrame(EVENTS, SCHEMA).selectExpr("*", "'x' as conv", "1 as turn_no", "'y' as formatted")
    turns = {}
    for r in sorted(chat.format_chats(log).collect(), key=lambda r: (str(r.conv_id), r.turn_no)):
        turns.setdefault(r.conv_id, []).append(chat.read_back(r.formatted))
    assert turns == {
        1: [("user", "hi"), ("assistant", "hello there"), ("user", "fixed"), ("assistant", "good one")],
        2: [("", "")], None: [("user", "x"), ("user", "x")], 3: [("assistant", "ab")],
    }


def test_digests_are_read_from_the_output(spark):
    rows = [(5, 1, "assistant", "</s>[INST] ok"), (5, 0, "user", "q\\"), (5, 2, "user", None), (5, 3, "assistant", "é")]
    rows += [(6, k, ("user", "assistant")[k % 2], "t" * k) for k in range(2500)]
    given_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.digest_chats(chat.format_chats(chat.as_events(given_))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in (5, 6):
        own = sorted(r for r in rows if r[0] == conv)
        loss = "".join(t or "" for _, _, role, t in own if role == "assistant")
        r = out[conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{role}\n{t or ''}\n" for _, _, role, t in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars > sum(len(t or "") for _, _, _, t in own)


def turns_of(rows):
    """Digests by walking over the given rows."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        loss = "".join(t or "" for _, _, role, t in own if role == "assistant")
        plain = "".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in own)
        out[conv] = (len(own), sha(plain), len(loss), sha(loss))
    return out


def test_deltas_edits_and_regenerations_fold_back_to_the_given_turns(spark, monkeypatch):
    """Long, empty and null texts, repeated turns, and a conversation that holds most of all rows."""
    texts = ["", "hi", "é🙂" * 700, "x" * 9_000, "</s>[INST] \\ ok", "line\nbreak"]
    rows = [(c, t, ("user", "assistant")[t % 2], texts[(c + t) % 6]) for c in range(12) for t in range(6)]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(3_000)]
    rows += [(50, 1, "user", "a"), (50, 1, "user", "a"), (50, 1, "assistant", "b"), (51, 0, None, None)]
    given_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    log = chat.as_events(given_)
    kinds = {r.kind for r in log.select("kind").distinct().collect()}
    assert kinds == {"message", "delta", "edit", "regenerate"} and log.count() > len(rows)
    real, held = chat.store, {}
    monkeypatch.setattr(chat, "store", lambda df, name: held.setdefault(name, real(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = chat.format_chats(log)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert held["turns"].where("conv_id = 99").select("part").distinct().count() > 1  # not one task's work
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest_chats(turns).collect()}
    assert found == turns_of(rows)


def test_turns_that_were_stored_and_dealt_anew_have_the_same_digests(spark, tmp_path):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}") for c in range(50) for t in range(8)]
    given_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chat.format_chats(chat.as_events(given_)).repartition(7, "formatted").write.parquet(f"{tmp_path}/turns")
    found = chat.digest_chats(spark.read.parquet(f"{tmp_path}/turns")).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == turns_of(rows)
