import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from ledgerline.llm import bpe, queries
from tests.llm import edges

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_merges_of_one_word(encoding):
    ranks, rng = bpe.read_ranks(PATH), random.Random(1)
    for _ in range(300):
        word = "".join(rng.choice("abé ünthe12 の") for _ in range(rng.randint(1, 300))).encode()
        want = encoding._core_bpe.encode_single_piece(word)
        assert bpe.merge_word(word, ranks) == want
        if word not in ranks:
            assert bpe._merge_long(word, ranks) == want


def test_query(spark, sf, encoding):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op9_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = encoding.encode_ordinary(d["text"])
        assert got[d["doc_id"]] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                    hashlib.sha256(d["text"].encode()).hexdigest())


def test_awkward_rows(spark, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 20)
    df = edges.docs(spark)
    rows = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(((r[0], encoding.encode_ordinary(r[1] or "")) for r in edges.ROWS), key=order)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in rows), key=order) == want
    assert sorted(bytes(r["bytes"]) for r in rows) == sorted((r[1] or "").encode() for r in edges.ROWS)
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
