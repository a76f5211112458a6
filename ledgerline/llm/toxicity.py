"""Toxicity by a learned lexicon, matched with Levenshtein automata and weighed by context.

The lexicon is learned from labelled documents: words, and word beginnings,
that occur far more often in toxic ones.  It is kept as a trie; the automata of
all its terms run over the trie at once, as one automaton whose states are
sets of (trie node, edits left) and are made when a text first needs them.
A match near quotation marks or reporting words counts as quoted and weighs
less.  A small logistic model turns a text's matches into a score.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, columns, fresh, hash_sample, map_batches

#: Least number of toxic documents that hold a term.
SUPPORT_ROWS = 5
#: Least share of toxic documents among those that hold a term, and least log-likelihood ratio.
PRECISION, EVIDENCE = 0.3, 25.0
#: Least weight (log odds) at which a word counts as a misspelling of a term.
MISSPELLED = 1.5
#: Lengths of the word beginnings that may become terms.
STEMS = range(3, 8)
#: Terms of so many letters may be misspelled by one edit, and by two.
ONE_EDIT, TWO_EDITS = 5, 9
#: Words on either side that make the context of a match.
WINDOW = 6
#: Words per run by which copies are known.
SHINGLE = 5
#: Labelled documents that the final logistic model is fitted on, about.
SAMPLE = 20_000
#: Words that announce a quotation, in four languages (fixed values).
REPORTING = frozenset(
    "said says saying called calls wrote writes quote quoted quoting quotes word term "
    "dit disait appelle écrit mot terme citation cite "
    "sagte sagt nannte schrieb wort begriff zitat zitiert "
    "dijo dice llamó escribió palabra término cita citado".split())
#: Quotation marks (fixed values).
MARKS = frozenset("\"“”„«»‹›「」")

_WORD = r"[^\W_]+(?:[*@$][^\W_]+)*"


def words_of(text: str | None) -> list[str]:
    return regex.findall(_WORD, (text or "").lower())


def terms_of(words: set[str]) -> set[str]:
    """A document's words and their proper beginnings; a beginning ends in ``*``."""
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


class LexiconAutomaton:
    """All terms within their allowed edits, as one automaton over a trie.

    A state is a set of (node, edits used); reading a letter steps along the
    trie (match), stays (a letter too many), or passes to a child (a letter
    changed, or with the next letter, left out).  A term's node accepts at
    the word's end if the edits used are allowed for that term; a stem
    accepts, within its edits, whatever follows.  The words of a stem's family
    accept as the stem, within edits of their own.
    """

    def __init__(self, terms: dict[str, dict]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, int] | None] = [None]  # term, and the edits it allows
        self.budget = [0]  # most edits that any term below a node allows
        self.stem_at: dict[int, str] = {}
        self.allowed = {term: about["edits"] for term, about in terms.items()}
        for term, about in terms.items():
            self._insert(term.rstrip("*"), term, about["edits"], term.endswith("*"))
            for word in about.get("words", ()):
                self._insert(word, term, edits_of(word), False)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.stems: list[tuple[str, int] | None] = []
        self.start = self._state(self._closed({(0, 0)}))

    def _insert(self, letters: str, term: str, edits: int, stem: bool) -> None:
        at = 0
        self.budget[0] = max(self.budget[0], edits)
        for c in letters:
            if c not in self.children[at]:
                self.children[at][c] = len(self.children)
                self.children.append({})
                self.ends.append(None)
                self.budget.append(0)
            at = self.children[at][c]
            self.budget[at] = max(self.budget[at], edits)
        if stem:
            self.stem_at[at] = term
        else:
            self.ends[at] = (term, edits)

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """Add the states reached by leaving out letters of a term; keep the fewest edits per node."""
        todo, best = list(states), {}
        while todo:
            node, used = todo.pop()
            if best.get(node, 99) <= used:
                continue
            best[node] = used
            todo += [(child, used + 1) for child in self.children[node].values() if used < self.budget[child]]
        return frozenset(best.items())

    def _state(self, members: frozenset) -> int:
        if members in self.states:
            return self.states[members]
        number = self.states[members] = len(self.sets)
        found = [(used, self.ends[n][0]) for n, used in members if self.ends[n] and used <= self.ends[n][1]]
        self.sets.append(members)
        self.steps.append({})
        self.accepts.append(min(found)[::-1] if found else None)
        begun = [(used, self.stem_at[n]) for n, used in members if n in self.stem_at and used <= self.allowed[self.stem_at[n]]]
        self.stems.append(min(begun)[::-1] if begun else None)
        return number

    def _step(self, state: int, c: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, used in self.sets[state]:
            if c in self.children[node]:
                out.add((self.children[node][c], used))
            if used < self.budget[node]:
                out.add((node, used + 1))
            out |= {(child, used + 1) for child in self.children[node].values() if used < self.budget[child]}
        to = self._state(self._closed(out)) if out else -1
        self.steps[state][c] = to
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term, or None; of equally near ones a whole word comes first, then the longest stem."""
        state, stem = self.start, None
        for c in word:
            state = self.steps[state].get(c, -2) if c in self.steps[state] else self._step(state, c)
            if state < 0:
                return stem
            begun = self.stems[state]
            if begun and (stem is None or begun[1] <= stem[1]):
                stem = begun
        whole = self.accepts[state]
        return stem if whole is None or stem and stem[1] < whole[1] else whole


def edits_of(term: str) -> int:
    """Edits that a term allows: none for short words and short stems."""
    letters = len(term.rstrip("*"))
    return 2 if letters >= TWO_EDITS else 1 if letters >= ONE_EDIT else 0


class Matcher:
    """Matches of a text: (term, edits, quoted); words known to match nothing are remembered.

    ``ordinary`` words are no misspellings: they match only as they are written.
    """

    def __init__(self, terms: dict[str, dict], ordinary: frozenset[str] = frozenset()) -> None:
        self.automaton, self.clean = LexiconAutomaton(terms), set()
        self.ordinary = ordinary

    def hits(self, words: set[str]) -> dict[str, tuple[str, int]]:
        """{word: (term, edits)} of the words that match."""
        hits = {}
        for w in words - self.clean:
            found = self.automaton.match(w)
            if found and not (found[1] and w in self.ordinary):
                hits[w] = found
            else:
                self.clean.add(w)
        if len(self.clean) > 100_000:
            self.clean.clear()
        return hits

    def __call__(self, text: str | None) -> list[tuple[str, int, bool]]:
        words = words_of(text)
        hits = self.hits(set(words))
        if not hits:
            return []
        out, low = [], (text or "").lower()
        spans = [(m.start(), m.end(), m.group()) for m in regex.finditer(_WORD, low)]
        for i, (start, end, w) in enumerate(spans):
            if w in hits:
                first, last = spans[max(0, i - WINDOW)][0], spans[min(len(spans) - 1, i + WINDOW)][1]
                before, after = low[first:start], low[end:last]
                marks = sum(c in MARKS for c in before) % 2 == 1 and any(c in MARKS for c in after)
                near = any(s[2] in REPORTING for s in spans[max(0, i - WINDOW):i + WINDOW + 1])
                out.append((*hits[w], marks or near and any(c in MARKS for c in before + after)))
        return out


FEATURES = ("direct, best", "direct, sum", "direct, density", "quoted, best", "misspelled, best")
#: Prior of the logistic model: means of bias and coefficients; all have variance 1.
PRIOR = np.array([-3.0, 1.0, 0.5, 0.2, 0.2, 0.5])


def features(matches: list[tuple[str, int, bool]], text: str | None, weights: dict[tuple[str, bool], float]) -> list[float]:
    """What the logistic model sees (FEATURES): weights of direct, quoted and misspelled matches."""
    if not matches:
        return [0.0] * len(FEATURES)
    direct = [max(0.0, weights.get((t, e > 0), 0.0)) for t, e, quoted in matches if not quoted]
    quoted = [max(0.0, weights.get((t, e > 0), 0.0)) for t, e, q in matches if q]
    wrong = [max(0.0, weights.get((t, True), 0.0)) for t, e, q in matches if e > 0 and not q]
    return [max(direct, default=0.0), math.log1p(sum(direct)), math.log1p(1000 * sum(direct) / len(text)), max(quoted, default=0.0), max(wrong, default=0.0)]


def _kin(text: str | None) -> int:
    """Smallest hash of a text's runs of SHINGLE words: copies, and most near copies, share it."""
    words = words_of(text)
    return min(xxhash.xxh3_64_intdigest(" ".join(words[i:i + SHINGLE])) for i in range(max(1, len(words) - SHINGLE + 1))) >> 1


def _shared(train: DataFrame, scratch: Scratch) -> DataFrame:
    """Training rows (doc_id, text, _label, _part): ``_part`` is one over the rows of the label with the same ``_kin``.

    So a group of copies counts as one document, of either class alike.  The
    rows meet their group's size by a plain join that adaptive execution splits.
    """
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield b | {"_kin": [_kin(t.as_py()) for t in b["text"]]}

    narrow = train.select("doc_id", "text", "_label")
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    rows = scratch.keep(map_batches(narrow, f"doc_id {id_type}, text string, _label int, _kin long", run), "train")
    sizes = rows.groupBy("_label", "_kin").agg((F.lit(1.0) / F.count(F.lit(1))).alias("_part"))
    out = scratch.keep(rows.join(sizes.hint("merge"), ["_label", "_kin"]).select("doc_id", "text", "_label", "_part"), "shared")
    scratch.drop(rows)
    return out


def _counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents of either class that hold each term, copies as one."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        count: dict[str, list[float]] = {}
        for b in batches:
            for text, label, part in zip(b["text"], b["_label"].to_pylist(), b["_part"].to_pylist()):
                for t in terms_of(set(words_of(text.as_py()))):
                    count.setdefault(t, [0.0, 0.0])[label] += part
                if len(count) > 200_000:
                    yield {"term": list(count), "toxic": [n[1] for n in count.values()], "clean": [n[0] for n in count.values()]}
                    count = {}
        yield {"term": list(count), "toxic": [n[1] for n in count.values()], "clean": [n[0] for n in count.values()]}

    return (map_batches(rows.select("text", "_label", "_part"), "term string, toxic double, clean double", run)
            .groupBy("term").agg(*(F.round(F.sum(n), 6).alias(n) for n in ("toxic", "clean"))))


def _evidence(t: float, c: float, toxic: float, clean: float) -> float:
    """Log-likelihood ratio (G2) of a term's counts against the classes' sizes."""
    total, n = toxic + clean, t + c
    expected = n * toxic / total
    return 2 * (t * math.log(t / expected) + (c * math.log(c / (n - expected)) if c else 0.0))


def _telling(counts: DataFrame, toxic: float, clean: float) -> DataFrame:
    """The rows of ``counts`` (term, toxic, clean) that pass the tests of ``choose_terms``."""
    t, c = F.col("toxic"), F.col("clean")
    expected = (t + c) * (toxic / (toxic + clean))
    evidence = 2 * (t * F.log(t / expected) + F.when(c > 0, c * F.log(c / (t + c - expected))).otherwise(0.0))
    # a hair below the bound: choose_terms tests again, with the driver's logarithm
    return counts.where((t >= SUPPORT_ROWS) & (t >= PRECISION * (t + c)) & (t * clean > c * toxic) & (evidence >= EVIDENCE - 1e-6))


def choose_terms(counts: dict[str, tuple[float, float]], toxic: float, clean: float) -> dict[str, dict]:
    """The lexicon: of each family of words and their beginnings, the term that tells most.

    Terms are taken by falling log-likelihood ratio (ties: the longer term);
    one that begins, or is begun by, a term already taken is left out.  Words
    that a stem begins join it as its ``words``, with edits of their own.
    """
    good = {t: _evidence(*n, toxic, clean) for t, n in counts.items()
            if n[0] >= PRECISION * sum(n) and n[0] * clean > n[1] * toxic}
    kept: dict[str, dict] = {}
    begun: set[str] = set()  # beginnings of the terms taken
    for term in sorted(good, key=lambda t: (-good[t], -len(t.rstrip("*")), t)):
        body = term.rstrip("*")
        if good[term] < EVIDENCE:
            break
        if any(body[:n] + "*" in kept for n in range(1, len(body) + 1)) or term.endswith("*") and body in begun:
            continue
        t, c = counts[term]
        kept[term] = {"weight": math.log((t + 0.5) / (c + 0.5) * (clean + 1) / (toxic + 1)), "edits": edits_of(term)}
        begun |= {body[:n] for n in range(1, len(body) + 1)}
    for word in (t for t in sorted(good) if good[t] >= EVIDENCE and t not in kept and not t.endswith("*")):
        stem = next(word[:n] + "*" for n in range(1, len(word) + 1) if word[:n] + "*" in kept)
        kept[stem].setdefault("words", []).append(word)
    return kept


def _ordinary(rows: DataFrame, terms: dict[str, dict], toxic: float, clean: float) -> frozenset[str]:
    """Words within a term's edits that are no misspellings: clean documents hold them too often.

    Decided word by word, with two toxic documents as prior; the terms' edits
    stay on for all other words.  Only the words left out reach the driver.
    """
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        match, count = Matcher(terms), defaultdict(float)
        for b in batches:
            for text, label, part in zip(b["text"], b["_label"].to_pylist(), b["_part"].to_pylist()):
                for w, (_, e) in match.hits(set(words_of(text.as_py()))).items():
                    if e:
                        count[w, label] += part
        yield {"word": [k[0] for k in count], "label": [k[1] for k in count], "n": list(count.values())}

    odds = (F.col("t") + 2) / (F.col("c") + 0.25) * ((clean + 1) / (toxic + 1))
    found = (map_batches(rows.select("text", "_label", "_part"), "word string, label int, n double", run)
             .groupBy("word").agg(F.round(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)), 6).alias("t"),
                                  F.round(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)), 6).alias("c"))
             .where((F.col("c") > 0) & (F.log(odds) < MISSPELLED)).select("word").collect())
    return frozenset(r["word"] for r in found)


def _learned(rows: DataFrame, terms: dict[str, dict], ordinary: frozenset[str], toxic: float, clean: float) -> dict[tuple[str, bool], float]:
    """Weight of (term, misspelled): log odds of its documents, a misspelling's shrunk to a part of the term's.

    Words that are no misspellings are left out one by one, so what is left
    weighs MISSPELLED at least, or as much as the term.
    """
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        match, count = Matcher(terms, ordinary), defaultdict(float)
        for b in batches:
            for text, label, part in zip(b["text"], b["_label"].to_pylist(), b["_part"].to_pylist()):
                for t, wrong in {(t, e > 0) for t, e, _ in match(text.as_py())}:
                    count[t, wrong, label] += part
        yield {"term": [k[0] for k in count], "wrong": [k[1] for k in count], "label": [k[2] for k in count], "n": list(count.values())}

    found = (map_batches(rows.select("text", "_label", "_part"), "term string, wrong boolean, label int, n double", run)
             .groupBy("term", "wrong").agg(F.round(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)), 6).alias("t"),
                                           F.round(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)), 6).alias("c")).collect())
    by = {(r["term"], r["wrong"]): (r["t"], r["c"]) for r in found}
    weights = {}
    for term in terms:
        for wrong in (False, True):
            t, c = by.get((term, wrong), (0, 0))
            # a misspelling that was never seen weighs as if two toxic documents held it
            prior = 2.0 if wrong else 1.0
            odds = (t + prior) / (c + 0.25) * (clean + 1) / (toxic + 1)
            weights[term, wrong] = min(terms[term]["weight"], max(MISSPELLED, math.log(odds))) if wrong else math.log(odds)
    return weights


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bias and coefficients by Newton steps, towards PRIOR where the data say nothing."""
    x = np.column_stack([np.ones(len(x)), x]) if len(x) else np.zeros((0, len(PRIOR)))
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + (w - PRIOR)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        d = np.linalg.solve(h, g)
        w = w - np.clip(d, -2, 2)
        if np.abs(d).max() < 1e-9:
            break
    return w


def fit(train: DataFrame) -> dict:
    """Model of ``train`` (doc_id, text, _label).

    All training documents are counted; only terms that SUPPORT_ROWS toxic
    documents hold and that pass the tests of evidence and precision, made in
    Spark, reach the driver, whatever their share of the toxic documents.
    Without toxic documents the lexicon is empty and every score is the
    prior's.
    """
    scratch = Scratch(train.sparkSession, "toxic")
    rows = _shared(train, scratch)
    sizes = {r["_label"]: r for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("_part"), 6).alias("parts")).collect()}
    toxic, clean = (sizes[k]["parts"] if k in sizes else 0.0 for k in (1, 0))
    terms: dict[str, dict] = {}
    if toxic and clean:
        telling = _telling(_counts(rows), toxic, clean).collect()
        terms = choose_terms({r["term"]: (r["toxic"], r["clean"]) for r in telling}, toxic, clean)
    ordinary = _ordinary(rows, terms, toxic, clean) if terms else frozenset()
    weights = _learned(rows, terms, ordinary, toxic, clean) if terms else {}
    chosen = hash_sample(rows, sum(r["n"] for r in sizes.values()), SAMPLE)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        match = Matcher(terms, ordinary)
        for b in batches:
            yield {"x": [features(match(x), x, weights) for x in b["text"].to_pylist()], "y": b["_label"]}

    got = map_batches(chosen.select("text", "_label"), "x array<double>, y int", run).collect() if terms else []
    model = _logistic(np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float))
    scratch.drop(rows)
    return {"terms": terms, "ordinary": ordinary, "weights": weights, "model": model}


def score(docs: DataFrame, model: dict, names: tuple[str, str] = ("_score", "_matches")) -> DataFrame:
    """``docs`` with two more columns: score (0 to 1) and matches (term, edits, quoted).

    Null and empty texts have no matches and score the bias; repeated rows
    score alike; other columns pass unchanged (of these names: replaced).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score:double,matches:array<struct<term:string,edits:int,quoted:boolean>>>")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        match, kind = Matcher(m["terms"], m["ordinary"]), pa.struct([("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_())])
        for texts in batches:
            texts = texts.to_pylist()
            found = [match(t) for t in texts]
            x = np.array([[1.0, *features(f, t, m["weights"])] for f, t in zip(found, texts)]).reshape(len(found), len(PRIOR))
            p = 1 / (1 + np.exp(-np.clip(x @ m["model"], -30, 30)))
            yield pa.StructArray.from_arrays(
                [pa.array(p), pa.array([[{"term": t, "edits": e, "quoted": q} for t, e, q in f] for f in found], pa.list_(kind))],
                ["score", "matches"])

    rated = fresh(docs, "_rated")
    return docs.withColumn(rated, rate(F.col("text"))).select(
        *columns(docs, names), F.col(f"{rated}.score").alias(names[0]), F.col(f"{rated}.matches").alias(names[1]))
