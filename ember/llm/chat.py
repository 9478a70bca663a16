"""Operator 8: chat formatting by token-level assembly.

A turn is an opening mark, the text, and a closing mark; marks are reserved
ids above the vocabulary and never result from encoding text.  Texts are
encoded on their own and the reserved ids are spliced between them, so a
text's ids do not depend on its neighbours.  Running sums of the segment
lengths give every segment's place and with it the loss mask, which covers
exactly the ids of assistant texts.

In the rendered string marks are control strings, so their occurrences in a
text are escaped: a control string whose first character is followed by k
backslashes (k >= 0) gets one more; reading back takes one away.  The rule
maps k to k + 1 for every k and is therefore reversible.

Conversations are streamed in (conv_id, turn) order; one turn is in memory at
a time, whatever the length of a conversation.

Defined cases: null text or role is empty; rows with equal turn are ordered by
role and text; a null conversation id is a conversation of its own; roles
other than system, user and assistant are carried by a mark with the role's
text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm.packing import Encoder
from ember.session import ship_package

# The template: opening and closing mark of each role, and the marks of any other role.
ROLES = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ASST]", "</s>")}
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "[ROLE]", "[TEXT]", "[/ROLE]"
MARKS = [*(m for pair in ROLES.values() for m in pair), OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE]
LOSS_ROLE = "assistant"

_ESCAPE = re.compile("|".join(re.escape(m[0]) + r"\\*" + re.escape(m[1:]) for m in MARKS))
_UNESCAPE = re.compile("|".join(re.escape(m[0]) + r"\\+" + re.escape(m[1:]) for m in MARKS))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


class _Vocabulary:
    """Bytes of every id, and the reserved ids of the marks behind the vocabulary."""

    def __init__(self, path: str):
        self.encoder = Encoder.get(path)
        tok = self.encoder.tokenizer
        size = tok.get_vocab_size(with_added_tokens=True)
        # The byte-level alphabet of the tokenizer family: printable bytes stand for themselves.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in plain}
        byte.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
        self.bytes = [bytes(byte.get(c, 0) for c in tok.id_to_token(i) or "") for i in range(size)]
        self.mark = {m: size + i for i, m in enumerate(MARKS)}
        self.name = {i: m for m, i in self.mark.items()}

    def text(self, ids: np.ndarray) -> str:
        return unescape(b"".join([self.bytes[i] for i in ids.tolist()]).decode())


_vocabularies: dict[str, _Vocabulary] = {}


def _vocabulary(path: str) -> _Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = _Vocabulary(path)
    return _vocabularies[path]


_TURNS = "conv_id long, token_start long, ids binary, loss_start int, loss_end int, n_chars long"


def _assemble(path: str):
    def run(batches):
        vocabulary = _vocabulary(path)
        conv, at = object(), 0
        for batch in batches:
            convs = batch.column("conv_id").to_pylist()
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            # Segments of every turn: marks as reserved ids, texts by their place in the encoded list.
            plan, segments = [], []
            for role, text in zip(roles, texts):
                if role in ROLES:
                    head, tail = [ROLES[role][0]], ROLES[role][1]
                else:
                    head, tail = [OTHER_OPEN, len(segments), OTHER_TEXT], OTHER_CLOSE
                    segments.append(escape(role))
                plan.append([*head, len(segments), tail])
                segments.append(escape(text))
            ids, bounds = vocabulary.encoder.encode_text(segments) if segments else (np.zeros(0, np.uint32), [0])
            out = {"token_start": [], "ids": [], "loss_start": [], "loss_end": [], "n_chars": []}
            for c, role, steps in zip(convs, roles, plan):
                if c != conv:
                    conv, at = c, 0
                pieces = [np.array([vocabulary.mark[s]], np.uint32) if isinstance(s, str) else ids[bounds[s]:bounds[s + 1]]
                          for s in steps]
                ends = np.cumsum([len(p) for p in pieces])           # prefix sums place every segment
                masked = role == LOSS_ROLE
                out["token_start"].append(at)
                out["ids"].append(np.concatenate(pieces).astype("<u4").tobytes())
                out["loss_start"].append(int(ends[-3]) if masked else 0)
                out["loss_end"].append(int(ends[-2]) if masked else 0)
                out["n_chars"].append(sum(len(s) if isinstance(s, str) else len(segments[s]) for s in steps))
                at += int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(out["token_start"], pa.int64()), pa.array(out["ids"], pa.binary()),
                 pa.array(out["loss_start"], pa.int32()), pa.array(out["loss_end"], pa.int32()),
                 pa.array(out["n_chars"], pa.int64())],
                names=["conv_id", "token_start", "ids", "loss_start", "loss_end", "n_chars"])

    return run


def format_conversations(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """The ids of every turn of ``turns(conv_id, turn, role, text)`` in conversation order.

    ``token_start`` is the turn's place in its conversation, ``loss_start`` and
    ``loss_end`` the masked ids inside the turn, ``n_chars`` the length of the
    rendered string.
    """
    ship_package(turns.sparkSession)
    empty = F.lit("")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
                        F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_assemble(tokenizer_path), _TURNS)


def _read_turn(vocabulary: _Vocabulary, ids: np.ndarray) -> tuple[str, str]:
    opening = vocabulary.name[int(ids[0])]
    for role, (start, _) in ROLES.items():
        if opening == start:
            return role, vocabulary.text(ids[1:-1])
    cut = int(np.flatnonzero(ids == vocabulary.mark[OTHER_TEXT])[0])
    return vocabulary.text(ids[1:cut]), vocabulary.text(ids[cut + 1:-1])


def _read_back(path: str):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        vocabulary = _vocabulary(path)
        open_, state = False, None

        def fresh(conv):
            return {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

        def rows(done):
            return pa.RecordBatch.from_arrays(
                [pa.array([s["conv"] for s in done], pa.int64()), pa.array([s["turns"] for s in done], pa.int64()),
                 pa.array([s["all"].hexdigest() for s in done]), pa.array([s["loss_chars"] for s in done], pa.int64()),
                 pa.array([s["loss"].hexdigest() for s in done]), pa.array([s["chars"] for s in done], pa.int64())],
                names=names)

        for batch in batches:
            done = []
            for conv, raw, lo, hi, chars in zip(*(batch.column(c).to_pylist() for c in
                                                  ("conv_id", "ids", "loss_start", "loss_end", "n_chars"))):
                if not open_ or state["conv"] != conv:
                    if open_:
                        done.append(state)
                    open_, state = True, fresh(conv)
                ids = np.frombuffer(raw, "<u4")
                role, text = _read_turn(vocabulary, ids)
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
                masked = vocabulary.text(ids[lo:hi])
                state["loss"].update(masked.encode())
                state["loss_chars"] += len(masked)
                state["chars"] += chars
            if done:
                yield rows(done)
        if open_:
            yield rows([state])

    return run


def read_back(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """conv_id, n_turns and digests of what the ids of ``format_conversations`` say, one row a conversation."""
    return formatted.mapInArrow(
        _read_back(tokenizer_path),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
