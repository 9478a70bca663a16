import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ember.llm import chat
from ember.llm.catalog import CONTROL_TURNS, QUERIES
from ember.llm.chat import MARKS, escape, format_conversations, read_back, unescape
from tests.conftest import MEDIUM

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        chars = 0
        for _, _, r, t in turns:
            marks = chat.ROLES.get(r) or (chat.OTHER_OPEN, escape(r), chat.OTHER_TEXT, chat.OTHER_CLOSE)
            chars += sum(map(len, marks)) + len(escape(t))
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss), chars)
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = read_back(format_conversations(df, PATH), PATH).collect()
    want = expected(rows)
    assert len(out) == len(want) and {r[0]: tuple(r)[1:] for r in out} == want


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()] + CONTROL_TURNS
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op8_chat_format"](spark, MEDIUM).collect()}
    assert got == expected(rows)


def test_escaping_is_reversible():
    rnd = random.Random(3)
    bits = MARKS + ["\\", "[", "]", "<", "</", "s>", "INST]", "/INST]", "a", "[\\INST]", "<\\\\/s>", "<|endoftext|>"]
    for _ in range(5000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randrange(12)))
        e = escape(t)
        assert unescape(e) == t and not any(m in e for m in MARKS)


def test_control_strings_in_every_text(spark):
    rnd = random.Random(4)
    bits = MARKS + ["\\", " ok ", "é", "日本", "<|endoftext|>", "\n", "'s", "  "]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool", "[INST]", None]),
             "".join(rnd.choice(bits) for _ in range(rnd.randrange(9)))) for c in range(60) for t in range(5)]
    rnd.shuffle(rows)
    check(spark, rows)


def test_marks_are_spliced_and_texts_keep_their_own_ids(spark):
    tok = Tokenizer.from_file(PATH)
    rows = [(1, 0, "user", "hello there"), (1, 1, "assistant", "general")]
    turns = format_conversations(spark.createDataFrame(rows, SCHEMA), PATH).orderBy("token_start").collect()
    ids = [np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in turns]
    assert [i[1:-1] for i in ids] == [tok.encode(t).ids for _, _, _, t in rows]
    assert all(i[0] >= 50257 and i[-1] >= 50257 for i in ids)
    assert turns[1]["token_start"] == len(ids[0])
    assert (turns[0]["loss_start"], turns[0]["loss_end"]) == (0, 0)
    assert (turns[1]["loss_start"], turns[1]["loss_end"]) == (1, len(ids[1]) - 1)


def test_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, None, ""), (None, 0, "assistant", "x"), (2, None, "user", "b"), (2, 0, "user", "a"),
            (3, 0, "assistant", "long " * 60_000), (4, 0, "user", "same"), (4, 0, "user", "same")]
    check(spark, rows)
    many = [(9, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    check(spark, many)
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA), PATH), PATH).collect() == []
    extra = spark.createDataFrame([(1, 0, "user", "a", 5, "c")], SCHEMA + ", ids int, token_start string")
    assert read_back(format_conversations(extra, PATH), PATH).count() == 1
