"""Chat formatting: reversible, and masked exactly where assistants speak."""

import hashlib
import random

import numpy as np
from paths import BYTES
from hypothesis import given, settings
from hypothesis import strategies as st

from adstrata.llm import chat, queries

PIECES = [*chat.CONTROL, "\\", "<", "[", "|>", "é", " ", "\n", "im_end", "ok", "/"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), st.lists(st.sampled_from(PIECES), max_size=6).map("".join))
def test_escaping_is_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat.CONTROL_PATTERN.search(chat.escape(text))
    rendered = chat.render(role, text)[0]
    assert list(chat.turns(rendered * 2)) == [(role, text)] * 2


def test_mask_by_binary_search():
    rnd = random.Random(2)
    for _ in range(200):
        cuts = sorted(rnd.sample(range(60), 8))
        spans = np.array(cuts).reshape(-1, 2)
        begins = np.sort(np.array([rnd.randrange(60) for _ in range(20)]))
        ends = begins + np.array([rnd.randrange(4) for _ in range(20)])
        expected = [any(a < e and b < z for a, z in spans) and b < e for b, e in zip(begins, ends, strict=True)]
        assert chat.loss_mask(begins, ends, spans).tolist() == expected


def expected_rows(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        learned = "".join(text for _, _, role, text in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        found[conv] = (len(turns), sha(said), len(learned), sha(learned))
    return found


def check(found, rows):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found.collect()}
    assert got == expected_rows(rows)


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 200)
    rnd = random.Random(4)
    text = lambda: "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 15)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system"]), text(), "x", "y") for c in range(5) for t in range(rnd.randint(1, 9))]
    rows += [(7, t, "assistant" if t % 2 else "user", f"turn {t} " * 9, "x", "y") for t in range(200)]
    rows += [(None, 1, "assistant", "no conversation", "x", "y"), (8, None, None, None, "x", "y"), (8, 1, "assistant", None, "x", "y")]
    rows += [(9, 1, "assistant", "twice", "x", "y")] * 2 + [(9, 1, "user", "tie", "x", "y"), (10, 0, "assistant", "é😀" * 50_000, "x", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, Block string, ids string").repartition(3)
    blocks = chat.format_conversations(df, BYTES)
    check(chat.summarise(blocks), rows)
    long = [r for r in blocks.collect() if r.conv_id == 7]
    assert len(long) > 3
    tokenizer = chat.chat_tokenizer(open(BYTES).read())
    long.sort(key=lambda r: (r.block, r.part))
    whole = "".join(r.formatted for r in long)
    # Blocks encode as the whole conversation does.
    assert [i for r in long for i in r.ids] == tokenizer.encode(whole, add_special_tokens=False).ids


def test_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.summarise(chat.format_conversations(df, BYTES)).collect() == []


def test_query(spark, folder):
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(queries.op6_chat(spark, folder), rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])
