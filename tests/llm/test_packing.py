import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ember.llm.catalog import QUERIES
from ember.llm.packing import Encoder, curve_keys, hilbert_index, pack_documents
from tests.conftest import MEDIUM

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string"


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [1]


def verify(rows, docs, length=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == {i for i, _ in docs}
    for i, text in docs:
        ids, at = ids_of(text), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            raw = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(raw)
            at += r["length"]
        assert at == len(ids)
    used = 0
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= length
        used += at
    return used, len(sequences)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    used, n = verify(QUERIES["op10_packing"](spark, MEDIUM).collect(), docs)
    assert used / (n * 2048) > 0.98


def fuzz(n, seed):
    rnd = random.Random(seed)
    alphabet = ["'", "'s", "'re", "'ll", "'t", " ", "  ", "\n", "\t", "a", "B", "é", "9", "42", ".", "!?", "日", "　", "🙂",
                " ", "<|endoftext|>", "'d", "ve", "\0", "\r\n", "_", "ǅ", "²", "⅓"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(25))) for _ in range(n)]


def test_encoder_equals_the_library_on_odd_texts():
    enc = Encoder.get(PATH)
    rnd = random.Random(4)
    texts = fuzz(4000, 1) + ["".join(chr(rnd.randrange(32, 0xD7FF)) for _ in range(20)) for _ in range(500)]
    for lo in range(0, len(texts), 700):
        part = texts[lo:lo + 700]
        ids, bounds = enc.encode(part, 1)
        for k, t in enumerate(part):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == ids_of(t), repr(t)


def test_a_full_cache_starts_afresh():
    enc = Encoder(PATH)
    enc.limit = 50
    enc._fresh()
    texts = [f"word{i} and word{i * 7}" for i in range(300)]
    for lo in range(0, 300, 20):
        ids, bounds = enc.encode(texts[lo:lo + 20], 1)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [ids_of(t) for t in texts[lo:lo + 20]]


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = np.argsort(hilbert_index(cells, 3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_like_texts_are_near_on_the_curve():
    a = [f"the house of {i} and the garden of the town".encode() for i in range(20)]
    b = [f"maison jardin {i} ville pour les dans".encode() for i in range(20)]
    keys = curve_keys(a + b)
    assert len(set((np.argsort(keys) < 20)[:1])) == 1 and curve_keys([None, b""])[0] == curve_keys([b""])[0]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "long text " * 9000), (4, "a" * 30_000), (5, "x<|endoftext|>y")] + [
        (100 + i, "copy of a text") for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 AS length", "'c' AS offset", "1 AS key")
    out = pack_documents(df, PATH, length=64).collect()
    verify(out, rows, 64)
    for r in out:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
    twice = spark.createDataFrame([(1, "same words here"), (1, "same words here"), (None, "z")], SCHEMA)
    assert sum(r["length"] for r in pack_documents(twice, PATH).collect()) == 2 * len(ids_of("same words here")) + len(ids_of("z"))
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []
