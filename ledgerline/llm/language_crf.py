"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language: its features are letter n-grams, with
marks at both ends so that those at an end are affixes, and, for frequent
words, the word itself.  The transitions between words' languages are learned
from texts of the sample cut and joined across languages, so that text that
switches languages is labelled word by word.  Marginals come from the
forward-backward algorithm; a text's language is the one with the largest
mean marginal.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, map_batches

#: Labelled documents of each language that the model is fitted on, about.
SAMPLE = 400
#: Hashed n-gram features, and lengths of the n-grams (end marks included).
BUCKETS, LENGTHS = 1 << 16, (2, 3, 4, 5)
#: A word is in the lexicon if this share of a language's sample documents hold it.
FREQUENT = 0.02
#: Training sequences, words per piece of one, and passes over them.
SEQUENCES, PIECE, PASSES = 2400, (4, 24), 4
#: Numbers in the transition matrices of the words that are summed at a time: words x languages^2.
CELLS = 6_400_000

_WORD = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def first_words(text: str | None, most: int) -> list[str]:
    return [m.group() for m in islice(_WORD.finditer((text or "").lower()), most)]


def feature_rows(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, counts): weight rows of every word's features, word by word for each n-gram length in turn.

    Returned as one flat array per length, joined; ``counts`` has a row per
    length (and one for the lexicon) and a column per word.
    """
    text = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(points))  # letters to the word's end, this one included
    rows, counts = [], []
    for n in LENGTHS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), np.uint64(n))
        for i in range(n):
            h = (h ^ points[at + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        rows.append((h % np.uint64(BUCKETS)).astype(np.int64))
        counts.append(np.maximum(size - n + 1, 0))
    known = [lexicon.get(w, -1) for w in words]
    own = np.array(known, np.int64).reshape(-1)
    rows.append(BUCKETS + own[own >= 0])
    counts.append((own >= 0).astype(np.int64))
    return np.concatenate(rows), np.array(counts).reshape(len(LENGTHS) + 1, len(words))


def emissions(words: list[str], weights: np.ndarray, lexicon: dict[str, int]) -> np.ndarray:
    """Sum of every word's feature weights, per language."""
    rows, counts = feature_rows(words, lexicon)
    out, low = np.zeros((len(words), weights.shape[1])), 0
    for c in counts:
        high = low + int(c.sum())
        total = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(weights[rows[low:high]], axis=0, dtype=np.float64)])
        ends = np.cumsum(c)
        out += total[ends] - total[ends - c]
        low = high
    return out


def sweep(scores: np.ndarray, firsts: np.ndarray, trans: np.ndarray, start: np.ndarray, before: np.ndarray | None = None,
          after: np.ndarray | None = None, fill: bool = True) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
    """(marginals, state after the last word, state before the first) of words in chains that begin at ``firsts``.

    All chains lie one after the other: the matrix of a chain's first word
    forgets what came before.  The matrices are multiplied within blocks of
    equal length side by side, the blocks' products are run through in
    order, and then all blocks are filled in side by side (with ``fill``).
    Words cut out of a longer chain get the forward state ``before`` them and
    the backward state ``after`` them.
    """
    n, langs = scores.shape
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(trans - trans.max())
    width = max(1, int(n ** 0.5))
    blocks = -(-n // width)
    full = np.empty((blocks * width, langs, langs))
    np.multiply(move[None, :, :], psi[:, None, :], out=full[:n])
    full[firsts] = (np.exp(start - start.max()) * psi[firsts])[:, None, :]
    full[:n] /= full[:n].sum(axis=(1, 2), keepdims=True)
    full[n:] = np.eye(langs)
    full = full.reshape(blocks, width, langs, langs)
    product = full[:, 0].copy()
    for i in range(1, width):
        product = product @ full[:, i]
        product /= product.sum(axis=(1, 2), keepdims=True)
    into, onward = np.empty((blocks, langs)), np.empty((blocks, langs))
    at = np.full(langs, 1 / langs) if before is None else before
    for b in range(blocks):
        into[b] = at
        at = at @ product[b]
        at /= at.sum()
    last = at
    at = np.full(langs, 1 / langs) if after is None else after
    for b in range(blocks - 1, -1, -1):
        onward[b] = at
        at = product[b] @ at
        at /= at.sum()
    if not fill:
        return None, last, at
    forward = np.empty((blocks, width, langs))
    first, at = at, into
    for i in range(width):
        at = (at[:, None, :] @ full[:, i])[:, 0]
        at /= at.sum(axis=1, keepdims=True)
        forward[:, i] = at
    at = onward
    for i in range(width - 1, -1, -1):
        forward[:, i] *= at
        at = (full[:, i] @ at[:, :, None])[:, :, 0]
        at /= at.sum(axis=1, keepdims=True)
    gamma = forward.reshape(-1, langs)[:n]
    return gamma / gamma.sum(axis=1, keepdims=True), last, first


def marginals(scores: np.ndarray, firsts: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Forward-backward marginals of words in chains that begin at ``firsts``."""
    return sweep(scores, firsts, trans, start)[0]


def _sequences(docs: list[tuple[list[str], int]], langs: int, rng: np.random.Generator) -> list[tuple[list[str], list[int]]]:
    """Word sequences of one to three pieces, each of any document and language."""
    by = defaultdict(list)
    for words, lang in docs:
        if words:
            by[lang].append(words)
    names = sorted(by)
    out = []
    for _ in range(SEQUENCES if names else 0):
        words, gold = [], []
        for _ in range(int(rng.integers(1, 4))):
            lang = names[int(rng.integers(len(names)))]
            doc = by[lang][int(rng.integers(len(by[lang])))]
            n = int(rng.integers(*PIECE))
            at = int(rng.integers(max(1, len(doc) - n + 1)))
            words += doc[at:at + n]
            gold += [lang] * len(doc[at:at + n])
        out.append((words, gold))
    return out


def train(docs: list[tuple[list[str], int]], langs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """Weights, transitions, start scores and lexicon, by stochastic ascent of the likelihood."""
    rng = np.random.default_rng(1)
    held, size = defaultdict(Counter), Counter(lang for _, lang in docs)
    for words, lang in docs:
        held[lang].update(set(words))
    often = sorted({w for lang in held for w, n in held[lang].items() if n >= max(2, FREQUENT * size[lang])})
    lexicon = {w: i for i, w in enumerate(often)}
    sequences = _sequences(docs, langs, rng)
    vocabulary = {w: i for i, w in enumerate(sorted({w for words, _ in sequences for w in words}))}
    rows, counts = feature_rows(list(vocabulary), lexicon)
    # features word by word instead of length by length
    owner = np.concatenate([np.repeat(np.arange(len(vocabulary)), c) for c in counts])
    order = np.argsort(owner, kind="stable")
    rows, each = rows[order], counts.sum(axis=0)
    starts = np.cumsum(each) - each
    weights, trans, start = np.zeros((BUCKETS + len(lexicon), langs)), np.zeros((langs, langs)), np.zeros(langs)
    square, square_t, square_s = np.full_like(weights, 1e-4), np.full_like(trans, 1e-4), np.full_like(start, 1e-4)
    for _ in range(PASSES):
        order = rng.permutation(len(sequences))
        for low in range(0, len(order), 40):
            batch = [sequences[i] for i in order[low:low + 40]]
            lens = np.array([len(w) for w, _ in batch])
            ids = np.array([vocabulary[w] for words, _ in batch for w in words])
            gold = np.array([g for _, own in batch for g in own])
            c = each[ids]
            feats = rows[np.repeat(starts[ids] - (np.cumsum(c) - c), c) + np.arange(c.sum())]
            word = np.repeat(np.arange(len(ids)), c)
            scores = np.zeros((len(ids), langs))
            np.add.at(scores, word, weights[feats])
            firsts = np.cumsum(lens) - lens
            gamma = marginals(scores, firsts, trans, start)
            grad = -gamma
            grad[np.arange(len(ids)), gold] += 1
            inner = np.setdiff1d(np.arange(len(ids)), firsts)
            # pair marginals from neighbouring marginals' chains: p(a, b) ~ forward(a) move(a, b) backward(b)
            pair = _pairs(scores, firsts, inner, trans, start)
            grad_t = np.zeros_like(trans)
            np.add.at(grad_t, (gold[inner - 1], gold[inner]), 1)
            grad_t -= pair
            grad_s = grad[firsts].sum(axis=0)
            touched, place = np.unique(feats, return_inverse=True)
            g = np.zeros((len(touched), langs))
            np.add.at(g, place, grad[word])
            square[touched] += g * g
            weights[touched] += 0.1 * g / np.sqrt(square[touched])
            square_t += grad_t * grad_t
            trans += 0.1 * grad_t / np.sqrt(square_t)
            square_s += grad_s * grad_s
            start += 0.1 * grad_s / np.sqrt(square_s)
    return weights, trans, start, lexicon


def _pairs(scores: np.ndarray, firsts: np.ndarray, inner: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Expected transitions, summed over the words ``inner`` that have a word before them in their chain."""
    langs = scores.shape[1]
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    move, begin = np.exp(trans - trans.max()), np.exp(start - start.max())
    n, is_first = len(scores), np.zeros(len(scores) + 1, bool)
    is_first[firsts], is_first[n] = True, True
    forward, backward = np.empty((n, langs)), np.empty((n, langs))
    at = begin
    for t in range(n):
        at = (begin if is_first[t] else at @ move) * psi[t]
        at = forward[t] = at / at.sum()
    for t in range(n - 1, -1, -1):
        at = np.ones(langs) if is_first[t + 1] else move @ (psi[t + 1] * at)
        at = backward[t] = at / at.sum()
    joint = forward[inner - 1][:, :, None] * move * (psi[inner] * backward[inner])[:, None, :]
    return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def fit(train_docs: DataFrame) -> dict:
    """Model of ``train_docs`` (doc_id, text, lang); rows without a language or text are not used.

    The sample is a hash fraction of each language's different documents, so
    its size is about SAMPLE a language at any input, also where one doc_id or
    one row fills the table; one task fits the model.
    """
    spark = train_docs.sparkSession
    scratch = Scratch(spark, "language")
    usable = train_docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = scratch.keep(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "sizes")  # a row per language
    names = [r["lang"] for r in sizes.select("lang").orderBy("lang").collect()]
    if not names:
        return {"names": []}
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = (usable.join(sizes, "lang").where(draw * F.col("_n") < SAMPLE)
              .select("doc_id", "lang", "text").distinct().repartition(1).sortWithinPartitions("doc_id", "text", "lang"))
    number = {lang: i for i, lang in enumerate(names)}

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        docs = [(words_of(t), number[g]) for b in batches for t, g in zip(b["text"].to_pylist(), b["lang"].to_pylist())]
        weights, trans, start, lexicon = train(docs, len(number))
        yield {"weights": [weights.astype("<f4").tobytes()], "trans": [trans.ravel().tolist()], "start": [start.tolist()],
               "lexicon": [list(lexicon)]}

    m = map_batches(chosen.select("text", "lang"), "weights binary, trans array<double>, start array<double>, lexicon array<string>", run).first()
    langs = len(names)
    return {"names": names, "weights": np.frombuffer(m["weights"], "<f4").reshape(-1, langs),
            "trans": np.array(m["trans"]).reshape(langs, langs), "start": np.array(m["start"]),
            "lexicon": {w: i for i, w in enumerate(m["lexicon"])}}


def _scores(words: list[str], model: dict) -> np.ndarray:
    coded = pa.array(words, pa.string()).dictionary_encode()
    return emissions(coded.dictionary.to_pylist(), model["weights"], model["lexicon"])[coded.indices.to_numpy()]


def label_words(words: list[str], lens: list[int], model: dict) -> np.ndarray:
    """Marginals of every word; ``lens`` has the words of each text, none of them empty."""
    firsts = np.cumsum(lens) - np.array(lens)
    return marginals(_scores(words, model), firsts, model["trans"], model["start"])


def mean_marginals(text: str, most: int, model: dict) -> np.ndarray:
    """Mean marginals of the words of one text, ``most`` of them at a time.

    A first run carries the forward state from part to part and remembers one
    state and the place of each; a second one, from the last part to the
    first, carries the backward state and sums the marginals.
    """
    trans, start, text = model["trans"], model["start"], text.lower()
    found, parts, state = _WORD.finditer(text), [], None
    while own := list(islice(found, most)):
        parts.append((own[0].start(), own[-1].end(), state))
        firsts = np.zeros(1 if state is None else 0, int)
        state = sweep(_scores([m.group() for m in own], model), firsts, trans, start, state, None, False)[1]
    total, n, state = np.zeros(len(start)), 0, None
    for low, high, before in reversed(parts):
        firsts = np.zeros(1 if before is None else 0, int)
        gamma, _, state = sweep(_scores(_WORD.findall(text, low, high), model), firsts, trans, start, before, state)
        total, n = total + gamma.sum(axis=0), n + len(gamma)
    return total / n


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score, shares) of every row; shares: (lang, words' mean marginal), largest first.

    A null text, or one without letters, is ``und`` with score 0 and no
    shares; so is every text if there was nothing to learn from.  Letters are
    Unicode's (numbers such as a half or a Roman numeral sign are none).
    Repeated rows score alike; other columns are not read.  A task holds the
    numbers of CELLS / languages^2 words at a time, however long a text is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        m = shared.value
        names = m["names"]
        most = max(1, CELLS // max(1, len(names)) ** 2)

        def close(ids: list, words: list[str], lens: list[int]) -> dict:
            mean = np.zeros((len(ids), len(names)))
            some = [i for i, n in enumerate(lens) if n]
            if some and names:
                own = [lens[i] for i in some]
                gamma = label_words(words, own, m)
                mean[some] = np.add.reduceat(gamma, np.cumsum(own) - np.array(own), axis=0) / np.array(own)[:, None]
            return rated(ids, mean, [not n or not names for n in lens])

        def rated(ids: list, mean: np.ndarray, und: list[bool]) -> dict:
            best = mean.argmax(axis=1) if names else [0] * len(ids)
            return {"doc_id": ids, "lang_pred": ["und" if u else names[k] for u, k in zip(und, best)],
                    "score": [0.0 if u else float(min(1.0, row[k])) for u, k, row in zip(und, best, mean)],
                    "shares": [[] if u else sorted(({"lang": n, "share": float(p)} for n, p in zip(names, row)), key=lambda s: -s["share"])
                               for u, row in zip(und, mean)]}

        ids: list = []
        words: list[str] = []
        lens: list[int] = []
        for b in batches:
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"]):
                own = first_words(text.as_py(), most + 1)
                if len(own) > most and names:
                    yield rated([doc], mean_marginals(text.as_py(), most, m)[None, :], [False])
                    continue
                if len(words) + len(own) > most:
                    yield close(ids, words, lens)
                    ids, words, lens = [], [], []
                ids.append(doc)
                words += own
                lens.append(len(own))
        yield close(ids, words, lens)

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                       "doc_id long, lang_pred string, score double, shares array<struct<lang:string,share:double>>", run)
