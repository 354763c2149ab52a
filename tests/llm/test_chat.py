"""Chat formatting: escapes and templates as exact round trips, logs against a replay in order of sequence."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sixfold.llm import chat

PARTS = [*chat.STRINGS, "\\", "<", "[", "s>", "/s>", "INST]", "SYS>>", "/", "\n", " ", "é", "x", "user", "</SYS>>"]
hostile = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(hostile)
def test_escapes(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and not any(s in out for s in chat.STRINGS)
    assert chat.escape(out) != out or out == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "</s>", "<s>[INST]"]), hostile), max_size=6))
def test_reading_back(turns):
    written = [chat.render(*t) for t in turns]
    assert list(chat.read("".join(w for w, _, _ in written))) == turns
    assert [chat.unescape(w[a:b]) for w, a, b in written] == [t if r == "assistant" else "" for r, t in turns]


def replay(events):
    """The messages that a log leaves, event after event in order of sequence."""
    out = {}
    for conv, turn, seq, kind, role, text in sorted(events, key=lambda e: e[2]):
        held = out.setdefault(conv, {})
        if kind == "open":
            held[turn] = [role or "", text or ""]
        elif kind == "regenerate":
            for later in [t for t in held if t > turn]:
                del held[later]
            if turn in held:
                held[turn][1] = ""
        elif turn in held and kind in ("delta", "edit"):
            held[turn][1] = (held[turn][1] if kind == "delta" else "") + (text or "")
    return sorted((c, t, *m) for c, held in out.items() for t, m in held.items())


LOG = "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string, chunk string, formatted int"


@pytest.mark.parametrize("chunk", [1024, 3])
def test_logs(spark, monkeypatch, chunk):
    monkeypatch.setattr(chat, "CHUNK", chunk)
    rng = random.Random(chunk)
    events = []
    for conv in range(30):
        for seq in range(rng.choice([0, 3, 40, 200])):
            kind = rng.choices(["open", "delta", "edit", "regenerate", "other"], [40, 50, 6, 2, 2])[0]
            events.append((conv, rng.randint(0, 12), seq, kind, rng.choice(["user", "assistant", None]), rng.choice(["a", "</s>", "\n", None, "ü" * 40])))
    log = spark.createDataFrame([(*e, "x", 1) for e in events], LOG).repartition(5)
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.final_messages(log).collect())
    assert got == replay(events) and len(got) > 20
    digests = {}
    for conv, _, role, text in got:
        digests.setdefault(conv, []).append((role, text))
    read = {r.conv_id: r for r in chat.read_back(chat.final_messages(log)).collect()}
    assert read.keys() == digests.keys()
    for conv, turns in digests.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        assert (read[conv].n_turns, read[conv].turns_sha256) == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
        assert (read[conv].loss_chars, read[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert read[conv].formatted_chars == sum(len(chat.render(*t)[0]) for t in turns)


def test_tables_of_turns(spark):
    rng = random.Random(2)
    words = ["a", "b\n", "[INST]", "\n\n", "ü", "</s>\n", "\\", "\r\n"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), "".join(rng.choices(words, k=rng.randint(0, 30))), "x", 7) for c in range(20) for t in range(rng.randint(1, 9))]
    rows += [(30, t, ("user", "assistant")[t % 2], f"{t}\n", "x", 7) for t in range(5000)]  # several chunks
    rows += [(31, 0, "user", "line </s>\n" * 30_000, "x", 7), (32, 0, None, None, "x", 7), (32, None, "user", "first", "x", 7), (None, 0, "user", None, "x", 7), (None, 1, "assistant", "b", "x", 7)]
    rows += [(33, 1, "assistant", "same\ntext", "x", 7)] * 3 + [(33, 1, "assistant", "same", "x", 7), (33, 1, "user", "q", "x", 7), (34, (1 << 62), "assistant", "", "x", 7), (34, -(1 << 62), "assistant", "early", "x", 7)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", sha(r[3] or ""))
    wanted = []
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        learned = "".join(t for r, t in turns if r == "assistant")
        wanted.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), sum(len(chat.render(*t)[0]) for t in turns)))
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, seq string, kind int").repartition(4)
    found = lambda df: chat.read_back(chat.final_messages(chat.as_log(df), chat.TIES), chat.TIES).collect()
    assert sorted(map(tuple, found(df)), key=str) == sorted(wanted, key=str)
    assert found(df.where("false")) == []
