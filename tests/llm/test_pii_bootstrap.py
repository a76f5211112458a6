import hashlib
import random
import re
from collections import defaultdict

from ledgerline.llm import pii_bootstrap as pii
from ledgerline.llm import queries
from tests.llm import edges

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def expected_base(text):
    """The contract's expressions as they stand."""
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_plain_identifiers_of_random_texts():
    rng = random.Random(5)
    for alphabet in ("a.@-b+ ", "0123456789. ", "01234567890123456789 -", "+0123 ().-", "a1@.+() -é\n"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert pii.base_spans(text) == expected_base(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "@" * 400_000, "1." * 200_000, "+" * 400_000, "a@" * 200_000, "1 " * 200_000,
                 "(at)" * 100_000, "x" * 400_000 + "@example.com"):
        spans = pii.base_spans(text)
        list(pii._unseen(text, spans))


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op11_pii(spark, sf).collect()
    assert len(rows) == len(docs) and sum(r["n_email"] + r["n_phone"] for r in rows) > 0
    for r in rows:
        base = expected_base(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == i for b in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        assert set(listed(base).split(",")) <= set(r["spans"].split(","))


def brute_force(texts):
    """All spans per text, by dictionaries instead of joins."""
    seen = []
    for i, text in enumerate(texts):
        base = pii.base_spans(text)
        seen += [(i, s, e, k, 1 << k) for s, k, e in base] + [(i, s, e, -1, m) for s, e, m in pii._unseen(text, base)]
    name = {x: re.sub(r"[\s().-]", "", texts[x[0]][x[1]:x[2]]).lower() for x in seen}
    around = {x: pii.patterns(texts[x[0]], x[1], x[2]) for x in seen}
    holds, mask, seeds = defaultdict(set), defaultdict(int), defaultdict(set)
    for x in seen:
        mask[name[x]] |= x[4]
        if x[3] >= 0:
            seeds[name[x]].add(x[3])
        for p in around[x]:
            holds[p].add(name[x])
    score = {n: [float(k in seeds[n]) for k in range(4)] for n in mask}
    for _ in range(pii.ROUNDS):
        trusted = {}
        for p, of in holds.items():
            sums = [sum(score[n][k] for n in of) for k in range(4)]
            k = sums.index(max(sums))
            if sums[k] >= pii.SUPPORT and sums[k] >= pii.TRUST * len(of):
                trusted[p] = (k, sums[k] / len(of))
        for n in mask:
            if not seeds[n]:
                score[n] = [0.0] * 4
                for k in range(4):
                    doubt = 1.0
                    for p, (kind, trust) in trusted.items():
                        if kind == k and n in holds[p]:
                            doubt *= max(1 - trust, 1e-3)
                    if mask[n] >> k & 1 and 1 - doubt >= pii.TRUST:
                        score[n][k] = 1 - doubt
    out = [set(pii.base_spans(t)) for t in texts]
    for x in seen:
        if x[3] < 0 and not seeds[name[x]]:
            for p in around[x]:
                k = trusted[p][0] if p in trusted else None
                if k is not None and x[4] >> k & 1 and score[name[x]][k] >= pii.TRUST:
                    out[x[0]].add((x[1], k, x[2]))
    return [sorted(s) for s in out]


def contextual_texts():
    rng = random.Random(2)
    texts = [f"For questions call me at +1 (234) 555-{1000 + i} or write" for i in range(12)]
    texts += [f"mail: user{i}@example.com is the address" for i in range(9)]
    texts += [f"the host address 10.0.{i}.7 answered" for i in range(8)]
    unseen = ["so call me at 555-0199 or later", "mail: jane(at)example.org is new", "the host address fe80::1:2a answered",
              "second round: reach him via 555-0199 today"]
    # five of seven known instances are too few; with the one that the first round finds, six are enough
    second = [f"reach him via +1 (234) 555-{1000 + i} today" for i in range(5)]
    mixed = [f"order number {rng.randint(10**7, 10**8)} shipped" for _ in range(9)] + ["order number +1 (234) 555-1001 shipped"]
    return texts + unseen + second + mixed + ["reach him via 555-0142 today"]


def test_patterns_discover_unseen_identifiers_only_where_trusted(spark):
    texts = contextual_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(docs).collect()}
    want = brute_force(texts)
    assert got == dict(enumerate(want))

    def added(text):
        i = texts.index(text)
        return [(pii.KINDS[k], text[s:e]) for s, k, e in got[i] if (s, k, e) not in pii.base_spans(text)]

    assert added("so call me at 555-0199 or later") == [("phone", "555-0199")]
    assert added("mail: jane(at)example.org is new") == [("email", "jane(at)example.org")]
    assert added("the host address fe80::1:2a answered") == [("ip", "fe80::1:2a")]
    assert added("reach him via 555-0142 today") == [("phone", "555-0142")]  # trusted in the second round
    assert not any(added(t) for t in texts if t.startswith("order number"))


def test_copies_count_once(spark):
    """Many copies of one text are one instance of a pattern: no evidence for trusting it."""
    texts = ["ask for +1 (234) 555-1000 there"] * 40 + ["ask for 555-0101 there"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(len(r["spans"]) == len(r["base"]) for r in pii.find(docs).collect())


def test_awkward_rows(spark):
    docs = edges.docs(spark, edges.ROWS + [(20, "a@b.cd " * 3000, "en", "s", 1), (20, "a@b.cd " * 3000, "en", "s", 1)])
    rows = pii.find(docs).collect()
    assert len(rows) == len(edges.ROWS) + 2
    assert sorted(len(r["base"]) for r in rows)[-2:] == [3000, 3000]
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert pii.find(docs.limit(0)).collect() == []
