"""Alignment of two tokenizers' tokens, with corpus counts behind minimal perfect hashes.

First pass: documents are cut into blocks, and a block lists the distinct
pairs of ids that its documents link.  Every bucket of pairs gets a minimal
perfect hash of its distinct pairs, a table of their keys by slot, and a dense
vector of counts: tasks add their blocks' counts into vectors by slot, and the
vectors are summed in a tree.  Second pass: the blocks are aligned again, and
their pairs' counts are looked up by hash, the keys verified.

Both tokenizers are blind to what lies across a blank between two words, so
words (with the blank before them) are tokenized and aligned one by one, each
distinct word of a block once.
"""

from __future__ import annotations

import array
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import ragged
from ledgerline.llm.common import Scratch, map_batches

#: Characters after which a block is closed (a longer document makes a longer block).
BLOCK_CHARS = 2_000_000
#: Tokens, or links of documents to pairs, that are aligned or counted at a time (one word or document may have more).
PART = 100_000
#: Buckets of pairs.  Two vocabularies of 50,257 and 32,000 ids have 1.6 * 10^9 pairs, so a bucket has 25 million keys at most.
BUCKETS = 64
#: Blocks whose counts one vector takes, and vectors that are summed into one.
BLOCKS, FAN = 128, 16
#: Words that a task remembers, and characters from which a word goes to the slower tokenizer of n log n steps.
REMEMBERED, LONG_WORD = 250_000, 1_000
#: Characters of group texts that a task hands over at a time.
OUT_CHARS = 16_000_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_BLANKS = re.compile(r"\s\s")


def words_of(text: str) -> list[str]:
    """Blank + text, cut before each single blank between two words."""
    if _BLANKS.search(text) or text[0].isspace() or text[-1].isspace():
        head, *rest = _CUT.split(" " + text)
        return [head, *(" " + w for w in rest)]
    return (" " + text.replace(" ", "\0 ")).split("\0") if "\0" not in text else [" " + w for w in text.split(" ")]


def pack(values: np.ndarray) -> bytes:
    """An array as compressed byte planes."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def unpack(blob: bytes, kind: type) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 0) % np.uint64(BUCKETS)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct keys: levels of bit maps, a key lives where it is alone.

    The slot is the number of set bits before the key's bit over all levels.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits) - 1 + base)
            base += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            at = _mix(keys, len(levels) + 1) % np.uint64(2 * len(keys) + 8)
            alone = np.bincount(at.astype(np.int64), minlength=2 * len(keys) + 8) == 1
            levels.append(alone)
            keys = keys[~alone[at.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that is none of the hash's, -1 or any slot."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for i, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = (_mix(keys[open_], i + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return zstandard.ZstdCompressor(level=3).compress(head.tobytes() + b"".join(np.packbits(x).tobytes() for x in self.levels))

    @classmethod
    def load(cls, blob: bytes) -> PerfectHash:
        data = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes, low, levels = np.frombuffer(data, np.int64, n, 8), 8 + 8 * n, []
        for size in sizes.tolist():
            high = low + (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data[low:high], np.uint8), count=size).astype(bool))
            low = high
        return cls(levels)

    def verified(self, keys: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The slots of ``keys``, each checked against the key that ``table`` has there."""
        slots = self.slots(keys)
        if len(keys) and ((slots < 0).any() or (table[slots] != keys).any()):
            raise ValueError("a key is not in the table of its bucket")
        return slots


def byte_level_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabularies(a_path: str, b_path: str, pattern: str) -> dict:
    """What workers need of both tokenizers, as plain values; both files are of fixed size."""
    import sentencepiece

    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    letter, told = byte_level_letters(), json.loads(a_json)
    a_bytes = {i: bytes(letter[c] for c in t) for t, i in told["model"]["vocab"].items() if all(c in letter for c in t)}
    special = {t["id"] for t in told.get("added_tokens", [])}
    b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    if any(re.search("[^▁]▁", p) for p in pieces):
        raise ValueError("a piece runs across a blank")
    return {"a_json": a_json, "b_model": b_model, "pattern": pattern, "a_bytes": a_bytes,
            "ranks": {x: i for i, x in a_bytes.items() if i not in special},
            "b_bytes": [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)],
            "a_size": max(a_bytes) + 1, "b_size": len(pieces)}


class Tokenizers:
    """Both tokenizers in a worker: ids of distinct words, remembered in flat arrays."""

    def __init__(self, of: dict) -> None:
        import sentencepiece
        import tiktoken

        self.of = of
        self.fast = tiktoken.Encoding("a", pat_str=of["pattern"], mergeable_ranks=of["ranks"], special_tokens={})._core_bpe.encode_ordinary
        self.slow = None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=of["b_model"])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = (array.array("I"), array.array("I"))
        self.ends = (array.array("q", [0]), array.array("q", [0]))

    def encode_a(self, word: str) -> list[int]:
        if len(word) < LONG_WORD:
            return self.fast(word)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.of["a_json"])
            self.slow.encode_special_tokens = True
        return self.slow.encode(word, add_special_tokens=False).ids

    def places(self, words: list[str]) -> np.ndarray:
        """Numbers of the words in the flat arrays; new words are tokenized.

        A word whose tokens' bytes are not its own has none.
        """
        if len(self.known) > REMEMBERED:
            self.forget()
        known, (a_ids, b_ids), (a_ends, b_ends) = self.known, self.ids, self.ends
        new = [w for w in words if w not in known]
        a_bytes, b_bytes = self.of["a_bytes"], self.of["b_bytes"]
        for low in range(0, len(new), 20_000):
            part = new[low:low + 20_000]
            for word, b in zip(part, self.b.encode([w[1:] for w in part], num_threads=1)):
                a, own = self.encode_a(word), word.encode()
                if b"".join([a_bytes[i] for i in a]) == own and b"".join([b_bytes[i] for i in b]) == own:
                    a_ids.extend(a)
                    b_ids.extend(b)
                known[word] = len(a_ends) - 1
                a_ends.append(len(a_ids))
                b_ends.append(len(b_ids))
        return np.fromiter((known[w] for w in words), np.int64, len(words))

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(counts, ids) of A and of B of the words at ``places``, one after the other."""
        out = []
        for ids, ends in zip(self.ids, self.ends):
            edge, flat = np.array(ends), np.array(ids, np.uint32)
            counts = edge[places + 1] - edge[places]
            out += [counts.astype(np.uint32), flat[ragged(edge[places], counts)] if len(flat) else flat]
        return tuple(out)


class Aligned:
    """Groups and links of words whose tokens follow one another; ``sizes`` are the byte lengths of all ids of A and B."""

    def __init__(self, a_counts, a_ids, b_counts, b_ids, sizes: tuple[np.ndarray, np.ndarray]) -> None:
        self.a_counts, self.b_counts = a_counts.astype(np.int64), b_counts.astype(np.int64)
        self.a_ids, self.b_ids = a_ids.astype(np.int64), b_ids.astype(np.int64)
        a_end, b_end = np.cumsum(sizes[0][self.a_ids]), np.cumsum(sizes[1][self.b_ids])
        self.a_last = b_end[np.minimum(np.searchsorted(b_end, a_end), len(b_end) - 1)] == a_end if len(b_end) else np.zeros(0, bool)
        self.b_last = a_end[np.minimum(np.searchsorted(a_end, b_end), len(a_end) - 1)] == b_end if len(a_end) else np.zeros(0, bool)
        self.a_group, self.b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        edge = np.append(0, np.cumsum(self.a_last))[np.append(0, np.cumsum(self.a_counts))]
        self.groups = np.diff(edge)  # of each word
        self.word = np.repeat(np.arange(len(self.groups)), self.groups)  # of each group

    def links(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, key, times), by word and key: each word's distinct pairs and how often it links them."""
        def distinct(group, ids, size):
            pairs, times = np.unique(group * size + ids, return_counts=True)
            return pairs // size, pairs % size, times

        a_size = int(self.a_ids.max()) + 1 if len(self.a_ids) else 1
        ga, a, ta = distinct(self.a_group, self.a_ids, a_size)
        gb, b, tb = distinct(self.b_group, self.b_ids, b_size)
        here = np.bincount(gb, minlength=len(self.word))
        first = np.cumsum(here) - here
        left = np.repeat(np.arange(len(ga)), here[ga])
        right = ragged(first[ga], here[ga])
        times, word, key = ta[left] * tb[right], self.word[ga[left]], a[left] * b_size + b[right]
        order = np.lexsort((key, word))
        word, key, times = word[order], key[order], times[order]
        start = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (key[1:] != key[:-1]))) if len(word) else np.zeros(0, np.int64)
        return word[start], key[start], np.add.reduceat(times, start) if len(start) else times

    def texts(self, names: tuple[np.ndarray, ...]) -> list[str]:
        """The groups of each word, ``a1,a2|b1;`` each; ``names`` are id texts with the four separators."""
        a_mid, a_end, b_mid, b_end = names
        before = np.append(0, np.cumsum(np.bincount(self.b_group, minlength=len(self.word))))
        through = np.cumsum(np.bincount(self.a_group, minlength=len(self.word)))
        items = np.empty(len(self.a_ids) + len(self.b_ids), object)
        a_at, b_at = np.arange(len(self.a_ids)) + before[self.a_group], np.arange(len(self.b_ids)) + through[self.b_group]
        items[a_at] = np.where(self.a_last, a_end[self.a_ids], a_mid[self.a_ids])
        items[b_at] = np.where(self.b_last, b_end[self.b_ids], b_mid[self.b_ids])
        parts = items.tolist()
        lengths = np.append(0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))))
        whole = "".join(parts)
        cut = lengths[np.append(0, np.cumsum(self.a_counts + self.b_counts))].tolist()
        return [whole[s:e] for s, e in zip(cut, cut[1:])]


def _parts(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of consecutive items of about ``PART`` together, one item at least."""
    ends, low = np.cumsum(sizes), 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PART, "right")))
        yield slice(low, high)
        low = high


def _aligned(a_counts, a_ids, b_counts, b_ids, sizes: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, Aligned]]:
    """(number of the first word, Aligned) of the words of a block, some at a time: no word's groups depend on another's."""
    a_edge, b_edge = (np.append(0, np.cumsum(c, dtype=np.int64)) for c in (a_counts, b_counts))
    for some in _parts(a_counts.astype(np.int64) + b_counts):
        yield some.start, Aligned(a_counts[some], a_ids[a_edge[some.start]:a_edge[some.stop]],
                                  b_counts[some], b_ids[b_edge[some.start]:b_edge[some.stop]], sizes)


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive ``counts`` values."""
    edge = np.append(0, np.cumsum(values, dtype=np.int64))
    stop = np.cumsum(counts)
    return edge[stop] - edge[stop - counts]


_BLOCK = ("block long, ids array<long>, lens array<int>, codes binary, "
          "a_counts binary, a_ids binary, b_counts binary, b_ids binary, chunks array<struct<bucket:int,keys:binary,docs:binary>>")


def _blocks(shared, sizes) -> Callable:
    """Map documents to blocks: their tokens, and per bucket their distinct pairs with the documents that link them."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        both = Tokenizers(shared.value)
        first, made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0
        ids: list = []
        words: list[str] = []
        lens: list[int] = []
        chars = 0

        def close() -> dict:
            coded = pa.array(words, pa.string()).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = both.take(both.places(coded.dictionary.to_pylist()))
            each = np.array(lens, np.int64)
            doc = np.repeat(np.arange(len(each)), each)
            bad = np.zeros(len(each), bool)
            bad[doc[tokens[0][codes] == 0]] = True  # a word without tokens: its document has none
            keep = ~bad[doc]
            codes, doc, each = codes[keep], doc[keep], np.where(bad, 0, each)
            word, key = [], []
            for low, some in _aligned(*tokens, sizes):
                of, keys, _ = some.links(shared.value["b_size"])
                word.append((of + low).astype(np.uint32))
                key.append(keys.astype(np.uint32))
            n = np.bincount(_joined(word), minlength=len(tokens[0]))
            pairs, code = np.unique(_joined(key), return_inverse=True)
            del word, key
            begin, size = np.cumsum(n) - n, max(1, len(pairs))
            docs, edge = np.zeros(len(pairs), np.int64), np.append(0, np.cumsum(each))
            for some in _parts(_sums(n[codes], each)):  # of these documents, the distinct pairs of each
                own = np.repeat(np.arange(some.stop - some.start), each[some])
                held = np.unique(own * len(n) + codes[edge[some.start]:edge[some.stop]])  # a document's distinct words
                own, at = held // max(1, len(n)), held % max(1, len(n))
                spread = np.repeat(own, n[at]) * size + code[ragged(begin[at], n[at])]
                docs += np.bincount(np.unique(spread) % size, minlength=len(pairs))
            home, chunks = bucket_of(pairs[docs > 0]), []
            pairs, docs = pairs[docs > 0], docs[docs > 0]
            for bucket in np.unique(home):
                own = home == bucket
                chunks.append({"bucket": int(bucket), "keys": pack(pairs[own].astype(np.uint32)), "docs": pack(docs[own].astype(np.uint32))})
            return {"block": [first + made], "ids": [list(ids)], "lens": [each.tolist()], "codes": [pack(codes.astype(np.uint32))],
                    **{c: [pack(x)] for c, x in zip(("a_counts", "a_ids", "b_counts", "b_ids"), tokens)}, "chunks": [chunks]}

        for b in batches:
            for doc, text in zip(b["doc_id"], b["text"]):
                text = text.as_py() or ""
                got = words_of(text) if text else []
                ids.append(doc.as_py())
                words += got
                lens.append(len(got))
                chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield close()
                    made, chars = made + 1, 0
                    ids.clear(), words.clear(), lens.clear()
        if ids:
            yield close()

    return run


def _folded(rows: DataFrame, slices: int, schema: str, begin: Callable, add: Callable, end: Callable) -> DataFrame:
    """Fold the rows (by ``kind``, if they have one) of every (bucket, member % slices): begin() makes a state, add and end yield batches."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        at, state = None, None
        for b in batches:
            columns = {n: c.to_pylist() for n, c in b.items()}
            for i, here in enumerate(zip(columns["bucket"], columns["slice"])):
                if here != at:
                    if at is not None:
                        yield from end(at, state)
                    at, state = here, begin()
                yield from add(at, state, {n: c[i] for n, c in columns.items()})
        if at is not None:
            yield from end(at, state)

    dealt = rows.withColumn("slice", F.pmod("member", F.lit(slices)).cast("int")).drop("member")
    order = [c for c in ("bucket", "slice", "kind") if c in dealt.columns]
    return map_batches(dealt.repartition("bucket", "slice").sortWithinPartitions(*order), schema, run)


def _tree(rows: DataFrame, members: int, fan: int, combine: Callable, kind: type, scratch: Scratch, name: str) -> DataFrame:
    """One row (bucket, blob) per bucket: its arrays combined about ``fan`` at a time, level by level.

    ``rows`` has (bucket, member, blob), about ``members`` of a bucket; a task
    holds a few arrays of one bucket at a time.
    """
    def add(at, state, row):
        state.append(unpack(row["blob"], kind))
        if len(state) == 8:
            state[:] = [combine(state)]
        return ()

    def end(at, state):
        return [{"bucket": [at[0]], "member": [at[1]], "blob": [pack(combine(state))]}]

    while True:
        members = -(-members // fan)
        rows = scratch.keep(_folded(rows, members, "bucket int, member long, blob binary", list, add, end), name)
        if members == 1:
            return rows.select("bucket", "blob")


def _hash_bucket(batches: Iterator[dict]) -> Iterator[dict]:
    """(bucket, hash, keys): the perfect hash of a bucket's distinct keys, and the keys by slot."""
    for b in batches:
        for bucket, blob in zip(b["bucket"].to_pylist(), b["blob"].to_pylist()):
            keys = unpack(blob, np.uint32)
            found = PerfectHash.build(keys)
            table = np.empty_like(keys)
            table[found.slots(keys)] = keys
            yield {"bucket": [bucket], "hash": [found.dump()], "keys": [pack(table)]}


def _beside(found: DataFrame, tables: DataFrame, slices: int) -> DataFrame:
    """``found`` (bucket, member, block, keys, docs) with one row of its bucket's tables before the rows of each slice."""
    names = [c for c in ("hash", "keys", "blob") if c in tables.columns]
    head = tables.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("member"), F.lit(0).alias("kind"),
                         F.struct(*names).alias("tables"))
    rows = found.select("bucket", "member", F.lit(1).alias("kind"), "block", "keys", "docs")
    return head.unionByName(rows, allowMissingColumns=True)


def count_pairs(found: DataFrame, blocks: int, scratch: Scratch) -> DataFrame:
    """(bucket, hash, keys, blob): perfect hash, keys by slot and documents by slot of every bucket of pairs."""
    unique = _tree(found.select("bucket", "member", F.col("keys").alias("blob")), blocks, BLOCKS,
                   lambda x: np.unique(np.concatenate(x)), np.uint32, scratch, "distinct")
    hashes = scratch.keep(map_batches(unique, "bucket int, hash binary, keys binary", _hash_bucket), "hashes")
    slices = -(-blocks // BLOCKS)

    def add(at, state, row):
        if row["kind"] == 0:
            table = unpack(row["tables"]["keys"], np.uint32)
            state.update(hash=PerfectHash.load(row["tables"]["hash"]), keys=table, sums=np.zeros(len(table), np.int64))
        else:
            keys = unpack(row["keys"], np.uint32)
            state["sums"][state["hash"].verified(keys, state["keys"])] += unpack(row["docs"], np.uint32)  # a block's keys are distinct
        return ()

    vectors = scratch.keep(_folded(_beside(found, hashes, slices), slices, "bucket int, member long, blob binary", dict, add,
                                   lambda at, state: [{"bucket": [at[0]], "member": [at[1]], "blob": [pack(state["sums"])]}]), "vectors")
    sums = _tree(vectors, slices, FAN, lambda x: np.sum(x, axis=0), np.int64, scratch, "sums")
    return scratch.keep(hashes.join(sums.hint("merge"), "bucket"), "counted")


def _highest(counted: DataFrame, a_size: int, b_size: int) -> np.ndarray:
    """Per id of A the highest count of its pairs; as long as the vocabulary, so the driver can take it."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for keys, blob in zip(b["keys"].to_pylist(), b["blob"].to_pylist()):
                a = unpack(keys, np.uint32).astype(np.int64) // b_size
                order = np.argsort(a, kind="stable")
                ids, at = np.unique(a[order], return_index=True)
                yield {"a": ids, "best": np.maximum.reduceat(unpack(blob, np.int64)[order], at)}

    out = np.zeros(a_size, np.int64)
    for r in map_batches(counted.select("keys", "blob"), "a long, best long", run).groupBy("a").agg(F.max("best").alias("best")).collect():
        out[r["a"]] = r["best"]
    return out


def _looked_up(found: DataFrame, counted: DataFrame, blocks: int, best, b_size: int) -> DataFrame:
    """(block, bucket, keys, docs, best): counts of every block's pairs, and whether they are their A id's highest."""
    slices = -(-blocks // BLOCKS)

    def add(at, state, row):
        if row["kind"] == 0:
            t = row["tables"]
            state.update(hash=PerfectHash.load(t["hash"]), keys=unpack(t["keys"], np.uint32), sums=unpack(t["blob"], np.int64))
            return ()
        keys = unpack(row["keys"], np.uint32)
        docs = state["sums"][state["hash"].verified(keys, state["keys"])]
        high = docs == best.value[keys.astype(np.int64) // b_size]
        return [{"block": [row["block"]], "bucket": [at[0]], "keys": [row["keys"]], "docs": [pack(docs)], "best": [pack(high.astype(np.uint8))]}]

    return _folded(_beside(found, counted, slices), slices, "block long, bucket int, keys binary, docs binary, best binary", dict, add,
                   lambda at, state: ())


def _realigned(shared, sizes) -> Callable:
    """Map blocks with their pairs' counts to documents."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        a_size, b_size = shared.value["a_size"], shared.value["b_size"]
        names = tuple(np.array([f"{i}{end}" for i in range(n)], object) for n, end in ((a_size, ","), (a_size, "|"), (b_size, ","), (b_size, ";")))
        for b in batches:
            for i in range(len(b["ids"])):
                row = {n: c[i].as_py() for n, c in b.items()}
                tokens = [unpack(row[c], np.uint32) for c in ("a_counts", "a_ids", "b_counts", "b_ids")]
                codes, each = unpack(row["codes"], np.uint32).astype(np.int64), np.array(row["lens"], np.int64)
                parts = row["parts"] or []
                keys = np.concatenate([unpack(p["keys"], np.uint32) for p in parts] or [np.zeros(0, np.uint32)]).astype(np.int64)
                docs = np.concatenate([unpack(p["docs"], np.int64) for p in parts] or [np.zeros(0, np.int64)])
                high = np.concatenate([unpack(p["best"], np.uint8) for p in parts] or [np.zeros(0, np.uint8)]).astype(np.int64)
                order = np.argsort(keys)
                keys, docs, high = keys[order], docs[order], high[order]
                found, written = [], []
                for _, some in _aligned(*tokens, sizes):
                    word, key, times = some.links(b_size)
                    if len(keys):  # words of documents without tokens have pairs that no part lists; no document counts them
                        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                        n_docs, best = docs[at], high[at]
                    else:
                        n_docs, best = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
                    n = np.bincount(word, minlength=len(some.groups))
                    found.append((some.a_counts, some.b_counts, some.groups, _sums(times, n), _sums(times * best, n), _sums(times * n_docs, n)))
                    written += some.texts(names)
                per_word = [_joined(list(x)) for x in zip(*found)] or [np.zeros(0, np.int64)] * 6
                per_doc = [_sums(x[codes], each) for x in per_word]
                edge = np.append(0, np.cumsum(each)).tolist()
                places = codes.tolist()
                low, chars, out = 0, 0, []
                for d in range(len(each)):
                    out.append("".join([written[c] for c in places[edge[d]:edge[d + 1]]])[:-1])
                    chars += len(out[-1])
                    if chars >= OUT_CHARS or d + 1 == len(each):
                        yield {"doc_id": row["ids"][low:d + 1], "groups": out,
                               **{c: x[low:d + 1] for c, x in zip(("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), per_doc)}}
                        low, chars, out = d + 1, 0, []

    return run


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every text under two tokenizers.

    A is a byte-level BPE file (``pattern`` cuts its words), B a piece model
    that adds a blank before the text; special tokens in texts are text.
    ``groups`` lists the ids that share each group, ``a1,a2|b1;a3|b2,b3``.  A
    document is a row, repeated ids and texts included.  Texts that are null,
    empty or not given back by the tokens (those with U+2581) have no tokens.
    An empty table gives an empty result; other columns are not read.

    A frequent pair is one key per block and bucket.  Tasks hold a block, of
    which they align and count ``PART`` tokens or links at a time, or
    the distinct pairs of one bucket (the vocabularies bound them) and one
    row of a block at a time.  The driver takes one number per id of A.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    both = read_vocabularies(a_path, b_path, pattern)
    shared = spark.sparkContext.broadcast(both)
    sizes = np.array([len(both["a_bytes"].get(i, b"")) for i in range(both["a_size"])]), np.array([len(x) for x in both["b_bytes"]])
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = scratch.keep(map_batches(slim, _BLOCK, _blocks(shared, sizes)), "blocks")
    n = max(1, blocks.count())
    found = (blocks.select("block", F.explode("chunks").alias("c"))
             .select("c.bucket", F.xxhash64("block").alias("member"), "block", "c.keys", "c.docs"))
    counted = count_pairs(found, n, scratch)
    best = spark.sparkContext.broadcast(_highest(counted, both["a_size"], both["b_size"]))
    parts = (_looked_up(found, counted, n, best, both["b_size"])
             .groupBy("block").agg(F.collect_list(F.struct("keys", "docs", "best")).alias("parts")))
    joined = blocks.drop("chunks").join(parts.hint("shuffle_hash"), "block", "left").drop("block")
    return map_batches(joined, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string",
                       _realigned(shared, sizes))
