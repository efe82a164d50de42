"""Chat formatting: exact round trips, also of texts made of the template's own strings."""

import hashlib
import random

import numpy as np
import public_tokenizers
from clickloom.llm import chat

PIECES = ["#", "<", "/turn>", "\\", "|", " ", "\n", "a", "😀", "é", ".", "### User: ", "</turn>", ":", "endoftext|>", "<|"]
ROLES = ["user", "assistant", "assistant", "system", "", "User", "Assistant", "we:ird\\", "a: b", "### ", "assistant "]


def test_escape_is_reversible():
    for text in ("", "\\", "###", "####", "</turn>", "<\\/turn>", "<|endoftext|>", "a<", "##", "\\### Assistant: </turn> ok"):
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(mark in safe for mark in ("###", "</turn>", "<|"))


def test_random_conversations_come_back():
    rng = random.Random(1)
    tok = chat.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(1500):
        turns = [(rng.choice(ROLES), "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))) for _ in range(rng.randint(1, 5))]
        text, spans = chat.render(turns)
        assert chat.parse(text) == turns
        offsets = np.array(tok.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
        masked = chat.mask(offsets[:, 0].copy(), offsets[:, 1].copy(), [s for (r, _), s in zip(turns, spans) if r == "assistant"])
        at = np.flatnonzero(masked)
        runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []
        learned = "".join(chat.unescape(text[offsets[r[0], 0]:offsets[r[-1], 1]]) for r in runs)
        assert learned == "".join(t for r, t in turns if r == "assistant")


def test_table_with_nulls_and_repeats(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, "user", "x"), (None, 0, None, ""), (2, 0, "assistant", ""),
            (1, 1, "assistant", "b"), (3, None, "user", "y" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS ids")
    got = {(r.conv_id, r.text[:30]): r for r in chat.format_chats(df).collect()}
    assert len(got) == 5
    first = next(r for (c, _), r in got.items() if c == 1)
    assert chat.parse(first.text) == [("user", ""), ("assistant", "b"), ("assistant", "b")]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_query_digests(spark):
    from conftest import SF_SMALL
    rows = {r.conv_id: r for r in chat.op5_chat_format(spark, SF_SMALL).collect()}
    turns: dict = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert rows.keys() == turns.keys()
    for conv, want in turns.items():
        whole = "".join(f"{role}\n{text}\n" for role, text in want)
        loss = "".join(text for role, text in want if role == "assistant")
        assert rows[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (rows[conv].loss_chars, rows[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
