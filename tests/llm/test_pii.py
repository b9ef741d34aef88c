import math
import re
from collections import defaultdict
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st

from nearcast.llm import pii

SCHEMA = "doc_id long, text string"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """The rules as they are stated, by one search each."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, lo, hi in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if lo <= len(digits) <= hi and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab_@.+-( )0123456789é ", max_size=60))
def test_rules_against_one_search_each(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111111111111111", "+1 (499) 555-6503", "+49 30 1234567",
                                 "a.b@c.d_e@f.g", "x@y", "@a.b", "007.08.9.010", " ", "-", ".", "é", "9" * 5000]), max_size=8))
def test_rules_on_joined_parts(parts):
    if "9" * 5000 in parts and any("." in p for p in parts):
        parts = [p for p in parts if p != "9" * 5000]
    text = "".join(parts)
    assert pii.base_spans(text) == plain(text)


def test_long_texts_are_read_once():
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 200_000, "+1" * 200_000, "1." * 200_000, "1 " * 200_000, "(" * 400_000 + "1"):
        seeds = pii.base_spans(text)
        assert len(seeds) <= len(text)
    assert len(list(pii.candidates("12345 " * 50_000, []))) == 4 * 50_000 - 6


def brute(texts, confident=pii.CONFIDENT):
    """The rounds in dictionaries."""
    seen = []
    for n, text in enumerate(texts):
        text = text or ""
        seeds = plain(text)
        for kind, b, e in [*seeds, *((None, *c) for c in pii.candidates(text, seeds))]:
            seen.append((n, kind, b, e, text[b:e], set(pii.patterns(text, b, e))))
    seeds, holds = {}, defaultdict(set)
    for _, kind, _, _, value, patterns in seen:
        if kind and (value not in seeds or pii.KINDS.index(kind) < pii.KINDS.index(seeds[value][0])):
            seeds[value] = (kind, 1.0)
        for p in patterns:
            holds[p].add(value)
    known = dict(seeds)
    for _ in range(pii.ROUNDS):
        votes = defaultdict(lambda: defaultdict(float))
        for values in holds.values():
            support = defaultdict(float)
            for v in values:
                if v in known:
                    support[known[v][0]] += known[v][1]
            for kind, s in support.items():
                confidence = round(s / (len(values) + 1), 9)
                if confidence >= confident:
                    for v in values:
                        votes[v][kind] += math.log(1 - min(confidence, 1 - 1e-9))
        now = {v: min(((k, round(1 - math.exp(s), 9)) for k, s in by.items()), key=lambda x: (-x[1], pii.KINDS.index(x[0]))) for v, by in votes.items()}
        now |= seeds
        if len(now) == len(known) and known is not seeds and now.keys() == known.keys():
            known = now
            break
        known = now
    out = []
    for n, text in enumerate(texts):
        taken = plain(text or "")
        hits = [(-known[v][1], b - e, b, e, known[v][0]) for m, kind, b, e, v, _ in seen if m == n and kind is None and v in known]
        new = []
        for _, _, b, e, kind in sorted(hits):
            if all(e <= x or y <= b for _, x, y in new):
                new.append((kind, b, e))
        out.append(sorted(taken + new, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2])))
    return out


def listed(spans):
    return ",".join(":".join(map(str, s)) for s in spans)


def row(doc_id, text, spans):
    base = sorted(plain(text or ""), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    return (doc_id, *(sum(s[0] == k for s in base) for k in pii.KINDS), sha256(listed(base).encode()).hexdigest(), listed(spans))


def check(df):
    rows = df.select("doc_id", "text").collect()
    want = [row(r.doc_id, r.text, s) for r, s in zip(rows, brute([r.text for r in rows]), strict=True)]
    got = sorted(map(tuple, pii.personal_data(df).collect()), key=str)
    assert got == sorted(want, key=str)
    return got


def valid_card(i):
    head = f"4{i * 7919 % 10**14:014d}"
    return next(head + str(d) for d in range(10) if luhn(head + str(d)))


def planted():
    """Nine cards after the same words, then one with a wrong check digit; numbers elsewhere; neighbours that the rules join."""
    texts = [f"please charge my card number {valid_card(i)} today thank you {i % 3}" for i in range(9)]
    wrong = valid_card(77)[:-1] + str((int(valid_card(77)[-1]) + 1) % 10)
    texts += [f"please charge my card number {wrong} today thank you", f"the parcel {wrong[::-1]} is late", "order 5551234567 shipped in 2024"]
    texts += [f"call me at +1 ({200 + i}) 555-{1000 + i} after noon" for i in range(8)]
    texts += [f"parcel {i}000111122223333 left depot {i}" for i in range(1, 9)]  # as many digits, but no cards
    texts += ["reach +1 (444) 555-9876 10.20.30.40 any time", "version 10.2 of 1999", valid_card(3) + " " + valid_card(4)]
    return texts, wrong


def test_contexts_discover_what_rules_miss(spark):
    texts, wrong = planted()
    got = {r[0]: r[-1] for r in check(spark.createDataFrame(list(enumerate(texts)), SCHEMA))}
    at = texts[9].index(wrong)
    assert got[9] == f"card:{at}:{at + 16}" and got[10] == got[11] == got[29] == ""  # the context decides, not the shape
    assert got[28] == "ip:24:35,phone:6:23"
    assert got[30] == "card:0:16,card:17:33"
    assert [got[i] for i in range(20, 28)] == [listed(plain(texts[i])) for i in range(20, 28)]


def test_driver_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_nulls_repeated_rows_and_clashing_columns(spark):
    texts = [None, "", " ", "x@y.zz", "1" * 2000, "ü+49 30 1234567 é a@b.c", *planted()[0]]
    df = spark.createDataFrame([(i, t) for t in texts for i in (1, 1, None)], SCHEMA)
    check(df)
    for name in ("kind", "base", "seen", "spans", "uid", "value", "patterns", "start", "end", "score"):
        df = df.withColumn(name, df.text)
    check(df)
    assert pii.personal_data(df.limit(0)).collect() == []
