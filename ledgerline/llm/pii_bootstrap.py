"""Personal data by bootstrapped contextual extraction.

Fixed expressions find the plain identifiers (email, ip, card, phone).  They
seed a pattern-instance graph: an instance is an identifier's text, a pattern
the words around one of its occurrences ("call me at _").  Spark scores the
graph in rounds: a pattern is trusted for a kind as far as the instances it
stands around are of that kind, and an instance that is not known yet becomes
one of the kind through the trusted patterns around it.  Occurrences of such
instances inside a trusted pattern are the spans that the method adds.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, map_batches

KINDS = ("email", "ip", "card", "phone")
#: Distinct instances of its kind that a trusted pattern stands around at least, and their least share of all it stands around.
SUPPORT, TRUST = 5, 0.8
#: Rounds of scoring patterns from instances and instances from patterns.
ROUNDS = 3
#: Characters of an unseen identifier and of a context word at most.
LONGEST, WORD = 254, 32

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Digits only start a match where their run starts, and runs are never given back: one step per character.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_AT = re.compile(r"(?<!\S)\S*?[(\[]at[)\]]\S*+", re.I)
_NUMBERS = re.compile(r"[(+]?[0-9][0-9()./+-]*[.,;:!?]*")
_ADDRESS = re.compile(r"\S+(?:@|[(\[]at[)\]])\S+", re.I)
_HOST = re.compile(r"[0-9a-f]*(?:[:.][0-9a-f]*){3,}", re.I)
_FIGURES = re.compile(r"[0-9()./+ -]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email expression, found from each ``@`` outwards (linear in the text)."""
    low, at = 0, text.find("@")
    while at >= 0:
        run = text[low:at]
        start = low + len(run.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", low)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain identifiers by start, then kind; the end is exclusive.

    Matches of one kind do not overlap; those that fail their kind's test are dropped.
    """
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _may_be(x: str) -> int:
    """Bit set of the kinds that an unseen identifier's form allows."""
    mask = 0
    if _ADDRESS.fullmatch(x):
        mask |= 1
    if _HOST.fullmatch(x) and _DIGIT.search(x):
        mask |= 2
    if _FIGURES.fullmatch(x):
        digits = len(_DIGIT.findall(x))
        mask |= 4 * (12 <= digits <= 19) | 8 * (7 <= digits <= 15)
    return mask


def _unseen(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, end, kinds its form allows) of the words with digits or an at sign outside the plain identifiers.

    Number words that single blanks separate count as one; words of more than
    twice ``LONGEST`` characters are no identifiers.
    """
    words = [m.span() for m in _MARKED.finditer(text)] if "@" in text or _DIGIT.search(text) else []
    if "(at)" in (low := text.lower()) or "[at]" in low:
        words = sorted({*words, *(m.span() for m in _AT.finditer(text))})
    ends = list(accumulate((e for _, _, e in taken), max))

    def free(s: int, e: int) -> bool:
        i = bisect_right(ends, s)  # the first plain identifier that ends behind s
        return i == len(taken) or taken[i][0] >= e

    joined: list[list] = []
    for s, e in words:
        if e - s > 2 * LONGEST or not free(s, e):
            continue
        number = bool(_NUMBERS.fullmatch(text, s, e))
        if joined and number and joined[-1][2] and s == joined[-1][1] + 1 and text[s - 1] == " ":
            joined[-1][1] = e
        else:
            joined.append([s, e, number])
    for s, e, _ in joined:
        if e - s > 2 * LONGEST:
            continue
        while s < e and (text[s] in "\"'[{<*#%$&|,;:!?=" or text[s] == "(" and ")" not in text[s:e]):
            s += 1
        while s < e and (text[e - 1] in ".,;:!?\"'>]}*#%$&|=" or text[e - 1] == ")" and "(" not in text[s:e]):
            e -= 1
        if 0 < e - s <= LONGEST and (mask := _may_be(text[s:e])):
            yield s, e, mask


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: two words before; the word before and after; a label before.

    Words are in lower case with zeros for digits; a pattern without a letter is none.
    """
    def plain(words: list[str], last: bool) -> list[str]:
        return [_DIGIT.sub("0", w[-WORD:] if last else w[:WORD]).lower() for w in words]

    left = plain(text[max(0, start - 3 * WORD):start].split()[-2:], True)
    right = plain(text[end:end + 2 * WORD].split()[:1], False)
    out = []
    if len(left) == 2:
        out.append(" ".join(left) + " _")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    if left and left[-1][-1] in ":=#":
        out.append(left[-1] + " _")
    return [p for p in out if any(c.isalpha() for c in p)]


def _instance(x: str) -> str:
    """Fixed-width name of an identifier's text, without its punctuation."""
    return xxhash.xxh3_128_hexdigest(re.sub(r"[\s().-]", "", x).lower())


def _span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, base_sha256, found): plain identifiers, and all occurrences with their patterns.

    One row per row of ``docs``; ``kind`` is -1 for words that are no plain
    identifier, ``mask`` the kinds that their form allows.
    """
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("row", "doc_id", "base", "base_sha256", "found")}
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"]):
                text = text.as_py() or ""
                base = base_spans(text)
                seen = [(s, e, k, 1 << k) for s, k, e in base] + [(s, e, -1, m) for s, e, m in _unseen(text, base)]
                out["row"].append(row)
                out["doc_id"].append(doc)
                out["base"].append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                out["base_sha256"].append(hashlib.sha256(_span_text(base).encode()).hexdigest())
                out["found"].append([{"start": s, "end": e, "kind": k, "mask": m, "instance": _instance(text[s:e]),
                                      "patterns": patterns(text, s, e)} for s, e, k, m in seen])
                row += 1
            yield out

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                       "row long, doc_id long, base array<struct<start:int,kind:int,end:int>>, base_sha256 string, "
                       "found array<struct<start:int,end:int,kind:int,mask:int,instance:string,patterns:array<string>>>", run)


def bootstrap(edges: DataFrame, seeds: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns (pattern, kind, trust) and accepted instances (instance, s0..s3) after ``ROUNDS`` rounds.

    ``edges`` has (pattern, instance) once each, ``seeds`` one row per
    instance: the kinds its form allows and a score for each kind (1 for plain
    identifiers).  Copies of a text add no edge, so they count once.
    """
    n = range(len(KINDS))
    known = seeds
    trusted = None
    for _ in range(ROUNDS):
        stats = (edges.join(known, "instance").groupBy("pattern")
                 .agg(F.count(F.lit(1)).alias("_all"), *[F.sum(f"s{k}").alias(f"f{k}") for k in n]))
        best = F.greatest(*[F.col(f"f{k}") for k in n])
        kind = F.coalesce(*[F.when(F.col(f"f{k}") == best, F.lit(k)) for k in n])
        trusted = scratch.keep(stats.where((best >= SUPPORT) & (best >= TRUST * F.col("_all")))
                               .select("pattern", kind.alias("kind"), (best / F.col("_all")).alias("trust")), "trusted")
        doubt = F.log(F.greatest(1 - F.col("trust"), F.lit(1e-3)))
        votes = (edges.join(trusted, "pattern").groupBy("instance")
                 .agg(*[(1 - F.exp(F.sum(F.when(F.col("kind") == k, doubt).otherwise(0.0)))).alias(f"v{k}") for k in n]))
        seeded = F.greatest(*[F.col(f"b{k}") for k in n]) > 0
        base = seeds.select("instance", "mask", *[F.col(f"s{k}").alias(f"b{k}") for k in n])

        def scored(k: int):
            new = F.coalesce(F.col(f"v{k}"), F.lit(0.0))
            fits = F.col("mask").bitwiseAND(1 << k) > 0
            return F.when(seeded, F.col(f"b{k}")).when(fits & (new >= TRUST), new).otherwise(0.0).alias(f"s{k}")

        known = scratch.keep(base.join(votes, "instance", "left").select("instance", "mask", *[scored(k) for k in n]), "known")
    return trusted, known


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, base_sha256, spans): plain identifiers, and all spans with those that the method adds.

    ``spans`` are structs (start, kind, end) by start and kind, the kind as its
    place in ``KINDS``.  One row per row of ``docs``, repeated rows included.
    Null and empty texts have no spans; a null doc_id stays null; an empty
    table gives an empty result.  Only doc_id and text are read.

    The graph holds identifiers and their surroundings, not the texts; its
    joins and sums are shuffles on patterns and instances with partial sums,
    and the rounds are written tables.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    rows = scratch.keep(scan(docs), "rows")
    seen = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    edges = scratch.keep(seen.select("instance", F.explode("patterns").alias("pattern")).distinct(), "edges")
    seeds = scratch.keep(seen.groupBy("instance").agg(
        F.bit_or("mask").alias("mask"),
        *[F.max((F.col("kind") == k).cast("double")).alias(f"s{k}") for k in range(len(KINDS))]), "seeds")
    trusted, known = bootstrap(edges, seeds, scratch)
    new = known.join(seeds.where(F.greatest("s0", "s1", "s2", "s3") == 0).select("instance"), "instance", "left_semi")
    score = F.element_at(F.array("s0", "s1", "s2", "s3"), F.col("kind") + 1)
    around = (seen.where((F.col("kind") < 0)).drop("kind").withColumn("pattern", F.explode("patterns"))
              .join(trusted, "pattern").where(F.col("mask").bitwiseAND(F.expr("shiftleft(1, kind)")) > 0)
              .join(new.drop("mask"), "instance").where(score >= TRUST))
    added = (around.select("row", F.struct("start", "kind", "end").alias("span")).distinct()
             .groupBy("row").agg(F.collect_list("span").alias("added")))
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    return rows.join(added, "row", "left").select("doc_id", "base", "base_sha256", spans.alias("spans"))
