import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ember.llm import id_store as S
from ember.llm.catalog import QUERIES
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text, end_id=0):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [end_id]


def test_perfect_hash_is_minimal_and_tells_strangers():
    rng = random.Random(3)
    for n in (0, 1, 2, 100, 20_000):
        keys = np.array(sorted(rng.sample(range(-10**12, 10**12), n)), np.int64)
        valid = np.ones(n, bool)
        if n > 1:
            valid[0] = False
            keys[0] = 0
        index = S.ShardIndex.load(S.ShardIndex.build(keys, valid, np.full(n, 3), 2).dump())
        assert sorted(index.hashed.slots(keys, valid).tolist()) == list(range(n))
        first, number = index.find(keys, valid)
        assert first.tolist() == list(range(n)) and (number == 1).all()
        other = np.arange(10**13, 10**13 + 5000)
        assert index.find(other, np.ones(5000, bool))[1].sum() == 0
        # 2 bits a key a level: the bits of all levels stay below 4 a key (e / (e - 1) of the first level's, rounded up to words).
        assert len(index.hashed.words) * 64 <= 4 * n + 64 * 24


def test_query_against_the_library(spark):
    got = {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op12_id_store"](spark, SMALL).collect()}
    start = 0
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    for d in rows:
        ids = library_ids(d["text"])
        assert got[d["doc_id"]] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_many_shards_shared_keys_and_missing_keys(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *[7] * 40, *range(-40, 40)]),
             rng.choice([None, "", "x" * 3000, "hi <|endoftext|> there", f"w{rng.randrange(5)} é"]), "no") for _ in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    manifest = S.write_store(docs, PATH, shard_bytes=20_000)
    listed = manifest.orderBy("shard").collect()
    assert len(listed) > 10 and sum(r["n_docs"] for r in listed) == len(rows)
    assert sum(r["low"] <= 7 <= r["high"] for r in listed) > 2              # one key over several shards
    assert [r["start"] for r in listed] == np.r_[0, np.cumsum([r["n_ids"] for r in listed])[:-1]].tolist()
    keys = docs.select("doc_id").union(spark.range(1000, 1100).toDF("doc_id"))
    got = S.read_documents(keys, manifest).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == \
        sorted((k is not None, k or 0, tuple(library_ids(t))) for k, t, _ in rows)
    # The documents lie one behind the other in key order.
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.r_[0, np.cumsum([r["n_tokens"] for r in got])[:-1]].tolist()
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert keys == sorted(keys)
    assert S.read_documents(spark.createDataFrame([(10**9,)], "doc_id long"), manifest).count() == 0


def test_files_hold_plain_ids(spark):
    docs = spark.createDataFrame([(2, "two words"), (1, "one")], "doc_id long, text string")
    row = S.write_store(docs, PATH, end_id=0).first()
    where, file = S._opened(row["payload"])
    with where.open_input_file(file) as f:
        assert np.frombuffer(f.read(), "<u2").tolist() == library_ids("one") + library_ids("two words")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = S.write_store(docs, PATH)
    assert manifest.count() == 0
    assert S.read_documents(spark.range(3).select(F.col("id").alias("doc_id")), manifest).count() == 0
