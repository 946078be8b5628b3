import hashlib
import random
import re

from ledgerlight.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(t):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, t or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, kind string, digest int")
    return [(r["doc_id"], [(s["kind"], s["start"], s["end"], s["value"], s["base"]) for s in r["spans"]]) for r in pii.personal_data(docs).collect()]


HARD = [
    "a@b.c.d@e.f a@b.c_d@e.f a@b.c..d@e.f x@y z@.q @a.b %+-@-.-",
    "1.2.3.4.5.6.7.8 300.1.1.1 1.1.1.256.9 001.002.003.0255 1..2.3.4 12345678901234567890.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111112222333344445555",
    "4111111111111111 and 4111111111111112, 4222222222222222222 5500-0000 0000-0004.",
    "+1 (988) 555-2485 +1234567 +1 2 3 4 5 6 7 8 +12 ()()() 3 +1+2 +1(((( ++44 20 7946 0958-",
    "é😀 a@b.cd 😀 +44 20 7946 0958 漢字 10.0.0.1",
    "no data at all",
    "",
    None,
]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(8)
    alphabet = "ab1 29.@+-()_%é" + "0" * 4
    rows = list(enumerate(HARD)) + [(100 + i, "".join(rng.choices(alphabet, k=rng.randrange(120)))) for i in range(400)]
    rows += [(900, "1 " * 60_000 + "a@b.cd"), (901, "a" * 100_000 + " x@y.zz " + "b." * 50_000), (902, "9" * 80_000), (903, "x@" + "a." * 30_000 + "b"), (904, "+1" + " (" * 50_000)]
    for i, spans in run(spark, rows):
        text = dict(rows)[i]
        assert sorted(s[:3] for s in spans if s[4]) == sorted(brute(text)), text[:200]
        for kind, start, end, value, _ in spans:
            assert text[start:end] == value
        order = [(pii.KINDS.index(s[0]), s[1]) for s in spans]
        assert order == sorted(order)


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"Sea {i} wall. Please call me on +1 (415) 555-{1000 + i} today or else") for i in range(12)]
    rows += [(50, "So please call me on (415) 555-7777 today then"), (51, "It lists 415 555 8888 units of stock"), (52, "And (415) 555-7777 again in another place"), (53, "Please call me on 12 34 today")]
    found = dict(run(spark, rows))
    added = {i: [s[3] for s in spans if not s[4]] for i, spans in found.items()}
    assert added[50] == ["(415) 555-7777"] and added[52] == ["(415) 555-7777"]
    assert not added[51] and not added[53] and not any(added[i] for i in range(12))


def words_around(text, start, end):
    before, after = re.findall(r"[^ \t-\r]+", text[:start]), re.findall(r"[^ \t-\r]+", text[end:])
    out = []
    if len(before) > 1:
        out.append(re.search(r"[^ \t-\r]+[ \t-\r]+[^ \t-\r]+(?=[ \t-\r]*$)", text[:start])[0] + " _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return [re.sub("[0-9]", "0", p).lower() for p in out]


def brute_added(rows):
    """Phone numbers without a plus that the rounds add, by plain loops: {id: values}."""
    loose = re.compile(r"(?<![0-9A-Za-z.(+-])\(?[0-9][ ().0-9-]{3,}[0-9]")
    spots, edges, known = [], {}, {}
    for i, text in rows:
        base = [(a, b) for kind, a, b in brute(text) if kind == "phone"]
        for a, b in base:
            known[re.sub("[^0-9]", "", text[a:b])] = 1.0
        for a, b in base + [m.span() for m in loose.finditer(text) if not any(x < m.end() and m.start() < y for x, y in base)]:
            value = re.sub("[^0-9]", "", text[a:b])
            spots.append((i, text[a:b], value, (a, b) in base))
            for p in words_around(text, a, b):
                edges.setdefault(p, set()).add(value)
    unseen = {v for *_, v, is_base in spots if not is_base and v not in known and 7 <= len(v) <= 15}
    scores, rounds = dict(known), 0
    while True:
        votes = {}
        for p, values in edges.items():
            have = [scores[v] for v in values if v in scores]
            if len(have) >= pii.LEAST_SEEDS and sum(have) / (len(values) + 1) >= pii.LEAST_PATTERN:
                votes[p] = sum(have) / (len(values) + 1)
        new = {}
        for v in unseen - set(scores):
            wrong = 1.0
            for p, values in edges.items():
                if v in values and p in votes:
                    wrong *= 1 - min(votes[p], 0.99)
            if 1 - wrong >= pii.LEAST_INSTANCE:
                new[v] = 1 - wrong
        if not new:
            return {i: sorted(s for j, s, v, b in spots if j == i and not b and v in scores and v not in known) for i, _ in rows}, rounds
        scores |= new
        rounds += 1


def test_rounds_go_on_until_nothing_is_new_as_plain_loops_do(spark):
    long = "w" * 70
    places = [("Please ring {} at noon", 0), (f"or {long} {{}} {long}é now", 1), ("or whisper {} softly to them", 2), ("\n \t" * 60 + "mail  fax {} only" + " " * 80, 3), ("So just text {} twice", 4)]
    sizes = [1500, 300, 60, 12, 2]
    number = lambda k, j: f"+1 (415) 5{k}5-{1000 + j}" if k == 0 else f"(415) 5{k}5-{1000 + j}"
    rows = []
    for text, k in places[:4]:
        rows += [(0, text.format(number(k, j))) for j in range(sizes[k])] + [(0, text.format(number(k + 1, j))) for j in range(sizes[k + 1])]
    rows += [(0, f"or {long[1:]}x 415 555 8888 {long} now"), (0, "No number 12 34 here"), (0, "It lists 415 555 9999 units")]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    want, rounds = brute_added(rows)
    got = {i: sorted(s[3] for s in spans if not s[4]) for i, spans in run(spark, rows)}
    assert rounds == 4 and sum(map(len, want.values())) == 2 * (300 + 60 + 12) + 2
    assert got == want


def test_digest_and_defined_cases(spark):
    rows = [(1, HARD[5]), (1, HARD[5]), (1, "another c@d.ef"), (None, "x@y.zz"), (2, None), (3, "10.0.0.1 " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.digest(pii.personal_data(docs)).collect()
    assert len(found) == len(rows)
    want = []
    for i, t in rows:
        spans = sorted(brute(t), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        sha = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        want.append((i, *[sum(s[0] == k for s in spans) for k in pii.KINDS], sha))
    got = [(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pii.personal_data(docs.limit(0)).count() == 0
