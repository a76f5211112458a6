import hashlib
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerline.llm import queries
from ledgerline.llm import token_alignment as ta
from tests.llm import edges

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def alphabet():
    """Bytes of the byte-level letters, by the published rule."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    out, n = {}, 0
    for b in range(256):
        out[chr(b) if b in plain else chr(256 + n)] = b
        n += b not in plain
    return out


def groups_of(text, tokenizers):
    """[(A ids, B ids)] of a whole text, by walking over both token lists."""
    a, b = tokenizers
    letters = alphabet()
    own = (" " + text).encode()
    xs = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    ys = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        ys.append((i, bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()))
    if not text or b"".join(x[1] for x in xs) != own or b"".join(y[1] for y in ys) != own:
        return []
    out, cur, i, j, p, q = [], ([], []), 0, 0, 0, 0
    while i < len(xs) or j < len(ys):
        if p <= q:
            cur[0].append(xs[i][0])
            p += len(xs[i][1])
            i += 1
        else:
            cur[1].append(ys[j][0])
            q += len(ys[j][1])
            j += 1
        if p == q:
            out.append(cur)
            cur = ([], [])
    return out


def expected(texts, tokenizers):
    found = [groups_of(t or "", tokenizers) for t in texts]
    count = Counter(pair for groups in found for pair in {(x, y) for xs, ys in groups for x in xs for y in ys})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups in found:
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        told = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), told))
    return out


AWKWARD = ["", " ", "a", "  two  blanks ", "tab\t and\nline \n end\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ is dropped",
           "text with ▁ inside", "\x00nul \x00 and \x1c\x85 signs", "中文字 と かな 🙂🙃 é è", "don't we'll  I'm  'quoted'",
           "x" * 5000, "ab " * 3000, "1234567890 " * 40, " nbsp  　wide", " lead", "trail ", "\n", "a\0b c"]


def test_words_do_not_change_the_tokens(tokenizers):
    a, b = tokenizers
    rng, signs = random.Random(4), "ab é\n\t'.1中🙂  \0 ▁<s>  "
    texts = AWKWARD[1:] + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    both = ta.Tokenizers(ta.read_vocabularies(A, B, public_tokenizers.PATTERN))
    for text in texts:
        words = ta.words_of(text)
        assert "".join(words) == " " + text
        assert sum((both.encode_a(w) for w in words), []) == a.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text:  # such texts are not given back by B and have no tokens
            assert sum((b.encode(w[1:]) for w in words), []) == b.encode(text)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 100_000):
        keys = rng.choice(1 << 31, n, replace=False).astype(np.uint32)
        found = ta.PerfectHash.load(ta.PerfectHash.build(keys).dump())
        slots = found.slots(keys)
        assert sorted(slots.tolist()) == list(range(n))  # minimal and perfect
        table = np.empty_like(keys)
        table[slots] = keys
        assert (found.verified(keys, table) == slots).all()
    with pytest.raises(ValueError):
        found.verified(np.array([k for k in range(50) if k not in set(keys.tolist())], np.uint32), table)


def run(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: tuple(r)[1:] for r in ta.align(docs, A, B, public_tokenizers.PATTERN).collect()}
    return [rows[i] for i in range(len(texts))]


@pytest.mark.parametrize("chars,blocks,fan", [(4_000_000, 128, 16), (300, 3, 2)])
def test_against_whole_texts(spark, tokenizers, monkeypatch, chars, blocks, fan):
    """Small blocks and fans: many blocks, and trees of several levels."""
    for name, value in (("BLOCK_CHARS", chars), ("BLOCKS", blocks), ("FAN", fan), ("BUCKETS", 4), ("OUT_CHARS", 500), ("REMEMBERED", 50)):
        monkeypatch.setattr(ta, name, value)
    rng = random.Random(8)
    words = ["the", "cat", "naïve", "tokenization", "Übergrößen", "2024", "don't", "中文", "end.\nNew"]
    texts = AWKWARD + [None] + [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    assert run(spark, texts) == expected(texts, tokenizers)


def test_query(spark, sf, tokenizers):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {}
    for d, (*numbers, told) in zip(docs, expected([d["text"] for d in docs], tokenizers)):
        want[d["doc_id"]] = (*numbers, hashlib.sha256(told.encode()).hexdigest() if numbers[0] else "")
    rows = queries.op13_token_alignment(spark, sf).collect()
    assert len(rows) == len(docs) and {r["doc_id"]: tuple(r)[1:] for r in rows} == want


def test_awkward_rows(spark, tokenizers):
    docs = edges.docs(spark)
    rows = ta.align(docs, A, B, public_tokenizers.PATTERN).collect()
    want = [(r[0], *w) for r, w in zip(edges.ROWS, expected([r[1] for r in edges.ROWS], tokenizers))]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted((tuple(r)[:1] + tuple(r)[1:] for r in rows), key=order) == sorted(want, key=order)
    assert ta.align(docs.limit(0), A, B, public_tokenizers.PATTERN).collect() == []


def test_a_task_aligns_some_words_of_a_block_at_a_time(tokenizers, monkeypatch):
    """Both passes over one block of 4,000 distinct words, documents without tokens and empty ones among them."""
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopq", k=rng.randint(3, 9))) for _ in range(200)) for _ in range(20)]
    texts += ["", "text with ▁ inside", texts[0], None]
    both = ta.read_vocabularies(A, B, public_tokenizers.PATTERN)
    sizes = np.array([len(both["a_bytes"].get(i, b"")) for i in range(both["a_size"])]), np.array([len(x) for x in both["b_bytes"]])
    shared, most, begin = SimpleNamespace(value=both), [], ta.Aligned.__init__

    def seen(self, a_counts, a_ids, b_counts, b_ids, sizes):
        most.append(len(a_ids) + len(b_ids))
        begin(self, a_counts, a_ids, b_counts, b_ids, sizes)

    monkeypatch.setattr(ta.Aligned, "__init__", seen)
    monkeypatch.setattr(ta, "PART", 500)
    (block,) = ta._blocks(shared, sizes)(iter([{"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)}]))
    want = Counter(p for t in texts for p in {(x, y) for xs, ys in groups_of(t or "", tokenizers) for x in xs for y in ys})
    got = {int(k): int(n) for c in block["chunks"][0] for k, n in zip(ta.unpack(c["keys"], np.uint32), ta.unpack(c["docs"], np.uint32))}
    assert got == {x * both["b_size"] + y: n for (x, y), n in want.items()}
    parts = [{"keys": c["keys"], "docs": ta.pack(ta.unpack(c["docs"], np.uint32).astype(np.int64)),
              "best": ta.pack(np.zeros(len(ta.unpack(c["docs"], np.uint32)), np.uint8))} for c in block["chunks"][0]]
    names = ("ids", "lens", "codes", "a_counts", "a_ids", "b_counts", "b_ids")
    out = [g for b in ta._realigned(shared, sizes)(iter([{n: pa.array(block[n]) for n in names} | {"parts": pa.array([parts])}])) for g in b["groups"]]
    assert out == [x[-1] for x in expected(texts, tokenizers)]
    assert len(most) > 20 and max(most) <= 500  # no word of these texts has more
