"""Personal data by bootstrapped contextual extraction.

Seeds are what plain rules find: mail addresses, IP addresses, payment cards
and phone numbers (``base_spans``). All other strings with an ``@`` or at least
four digits are candidates: one to four neighbouring words outside the seeds.
Seeds and candidates are *instances*; each occurrence has *lexical patterns*:
its shape (digits, letters and the characters between, with and without the
lengths of digit runs) and its shape together with the words left and right.

The graph of patterns and instances is scored in rounds, as joins and sums over
all documents:

* a pattern's confidence for a kind is the sum of its instances' scores for the
  kind, divided by the number of its instances and one more, so a pattern needs
  several instances, and every instance that nothing speaks for lowers it;
* an instance that is no seed has the score 1 - product(1 - confidence) over its
  patterns of at least ``CONFIDENT``, for its best kind.

Rounds end when no further instance gets a score. Every occurrence of an
instance with a score, and of a seed's string where the rules left it out (as
in two numbers side by side, which they read as one), is a span. Copies of a
document count once, because a pattern's instances are counted, not their
occurrences. The tables of the rounds hold distinct (pattern, instance) pairs
and sums of them; a hot pattern or instance is pre-aggregated in the tasks.

Defined cases: null and empty texts have no spans; rows that share an id and
repeated rows are rows of their own; null ids stay; an empty table gives no
row; extra columns are ignored. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Least confidence of a pattern that discovers, rounds at most, words of a candidate, digits of a candidate.
CONFIDENT, ROUNDS, WORDS, DIGITS = 0.8, 4, 4, 4

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"[\x20\x09-\x0D]")
BLANKS = frozenset(" \t\n\x0b\x0c\r")
#: What is cut from both ends of a word; a plus or a bracket may begin a number.
BEFORE, AFTER = "\"'`,;:!?.*#$%&|<>)]}=-/_~", "\"'`,;:!?.*#$%&|<>([{=-/_~"

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches: for every ``@``, the local characters before it that no earlier match has, and the domain after it."""
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (domain := DOMAIN.match(text, at + 1)):
            yield "email", begin, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def ips(text: str) -> Iterator[Span]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", m.start(), m.end()


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        digits = NO_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 8 <= len(NO_DIGIT.sub("", m.group())) <= 15:
            yield "phone", m.start(), m.end()


def base_spans(text: str) -> list[Span]:
    """Spans of the plain rules, by kind and start; matches of one kind do not overlap."""
    return [*emails(text), *ips(text), *cards(text), *phones(text)] if MARK.search(text) else []


def marked_words(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Words of text[begin:end] with a digit or an ``@``."""
    while m := MARK.search(text, begin, end):
        left = m.start()
        while left > begin and text[left - 1] not in BLANKS:
            left -= 1
        stop = SPACE.search(text, m.end(), end)
        yield left, stop.start() if stop else end
        begin = stop.end() if stop else end


def trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    while begin < end and text[begin] in BEFORE:
        begin += 1
    while begin < end and text[end - 1] in AFTER:
        end -= 1
    return begin, end


def candidates(text: str, seeds: list[Span]) -> Iterator[tuple[int, int]]:
    """Outside the seeds: up to ``WORDS`` neighbouring marked words with an ``@`` or enough digits."""
    at, gaps = 0, []
    for _, begin, end in sorted(seeds, key=lambda s: s[1:]):
        gaps.append((at, begin))
        at = max(at, end)
    for lo, hi in [*gaps, (at, len(text))]:
        words = [w for w in (trimmed(text, *x) for x in marked_words(text, lo, hi)) if w[0] < w[1]] if hi > lo else []
        for i, (begin, _) in enumerate(words):
            for j in range(i, min(i + WORDS, len(words))):
                if j > i and not text[words[j - 1][1]:words[j][0]].isspace():
                    break
                value = text[begin:words[j][1]]
                if "@" in value or len(NO_DIGIT.sub("", value)) >= DIGITS:
                    yield begin, words[j][1]


def shape(value: str, exact: bool) -> str:
    """Letters as ``a``, digits as ``9`` (with ``exact``, one for each digit)."""
    letters = re.sub(r"[^\W\d_]+", "a", value)
    return re.sub(r"[0-9]", "9", letters) if exact else re.sub(r"[0-9]+", "9", letters)


def neighbours(text: str, begin: int, end: int) -> tuple[str, str]:
    """The words left and right, lower case, digits as ``9``; empty at the ends of the text."""
    def word(x: str) -> str:
        return shape_of_digits(x.strip(BEFORE + AFTER).lower())
    i = begin
    while i > 0 and text[i - 1] in BLANKS:
        i -= 1
    left = i
    while left > 0 and text[left - 1] not in BLANKS:
        left -= 1
    j = end
    while j < len(text) and text[j] not in BLANKS:  # the rest of the last word
        j += 1
    while j < len(text) and text[j] in BLANKS:
        j += 1
    stop = SPACE.search(text, j)
    before = text[left:i] if i < begin or left == 0 else text[left:begin]
    return word(before), word(text[j:stop.start() if stop else len(text)])


def shape_of_digits(word: str) -> str:
    return re.sub(r"[0-9]+", "9", word)


def patterns(text: str, begin: int, end: int) -> list[str]:
    """Lexical patterns of an occurrence, most specific last; ``_`` stands for the occurrence."""
    value = text[begin:end]
    left, right = neighbours(text, begin, end)
    loose = shape(value, exact=False)
    return [loose, shape(value, exact=True), f"{left} _{loose}", f"_{loose} {right}", f"{left} _{loose} {right}"]


SPAN = "struct<kind: string, start: long, end: long>"
FOUND = f"base array<{SPAN}>, seen array<struct<kind: string, start: long, end: long, value: string, patterns: array<string>>>"


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``base`` (spans of the rules) and ``seen`` (all seeds and candidates with value and patterns; kind null: candidate)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    seen_at = pa.struct([*span, ("value", pa.string()), ("patterns", pa.list_(pa.string()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, seen = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                seeds = base_spans(text)
                rows = [*seeds, *((None, *c) for c in candidates(text, seeds))] if MARK.search(text) else []
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in seeds])
                seen.append([{"kind": k, "start": b, "end": e, "value": text[b:e], "patterns": patterns(text, b, e)} for k, b, e in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(seen, pa.list_(seen_at))],
                                             names=[id_col, "base", "seen"])
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return rows.mapInArrow(task, f"`{id_col}` long, {FOUND}")


def order_of(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def scored(seen: DataFrame, confident: float = CONFIDENT, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Instances (value, kind, score) that are seeds or discovered, and patterns (pattern, kind, confidence, instances).

    ``seen`` has kind (null: candidate), value and patterns, a row per occurrence.
    """
    seeds = materialize(seen.where("kind is not null").groupBy("value").agg(F.min_by("kind", order_of(F.col("kind"))).alias("kind"))
                        .withColumn("score", F.lit(1.0)))
    edges = materialize(seen.select("value", F.explode("patterns").alias("pattern")).distinct())
    instances = materialize(edges.groupBy("pattern").agg(F.count("*").alias("instances")))
    known, before, good = seeds, -1, None
    for _ in range(rounds):
        support = edges.join(known, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
        good = materialize(support.join(instances, "pattern").select(
            "pattern", "kind", F.round(F.col("support") / (F.col("instances") + 1), 9).alias("confidence"), "instances").where(F.col("confidence") >= confident))
        votes = edges.join(good, "pattern").groupBy("value", "kind").agg(
            F.round(1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(1 - 1e-9))))), 9).alias("score"))  # sums differ in their last digits
        best = votes.groupBy("value").agg(F.max_by("kind", F.struct("score", -order_of(F.col("kind")))).alias("kind"), F.max("score").alias("score"))
        known = materialize(seeds.unionByName(best.join(seeds.select("value"), "value", "left_anti")))
        n = known.count()
        if n == before:
            break
        before = n
    return known, good


def without_overlap(hits: list[dict]) -> list[dict]:
    """Hits of one text of which no two overlap: the best score first, then the longer and the earlier one."""
    taken: list[tuple[int, int, str]] = []
    for h in sorted(hits, key=lambda h: (-h["score"], h["start"] - h["end"], h["start"])):
        i = bisect_left(taken, (h["start"],))
        if (i == 0 or taken[i - 1][1] <= h["start"]) and (i == len(taken) or taken[i][0] >= h["end"]):
            taken.insert(i, (h["start"], h["end"], h["kind"]))
    return [{"kind": k, "start": b, "end": e} for b, e, k in taken]


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The overlaps of each text's hits settled (uid, hits -> uid, added)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        chosen = pa.array([without_overlap(h) for h in batch.column(1).to_pylist()], kind)
        yield pa.RecordBatch.from_arrays([batch.column(0), chosen], names=["uid", "added"])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", confident: float = CONFIDENT) -> DataFrame:
    """id, ``base`` and ``spans`` (base and discovered ones, by kind and start) of every row."""
    rows = materialize(occurrences(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()))
    seen = rows.select("uid", F.explode("seen").alias("s")).select("uid", "s.*")
    known, _ = scored(seen, confident)
    new = seen.where("kind is null").select("uid", "start", "end", "value").join(known.select("value", "kind", "score"), "value")
    each = new.groupBy("uid").agg(F.collect_list(F.struct("kind", "start", "end", "score")).alias("hits"))
    added = each.mapInArrow(settled, f"uid long, added array<{SPAN}>").select(F.col("uid").alias("__uid"), F.col("added").alias("__added"))
    out = rows.join(added, F.col("uid") == F.col("__uid"), "left")
    both = F.when(F.col("__added").isNull(), F.col("base")).otherwise(F.concat("base", "__added"))
    ordered = F.sort_array(F.transform(both, lambda s: F.struct(order_of(s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return out.select(id_col, "base", F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def listed(found: Column) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, and all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans(docs).select("doc_id", *[count(k) for k in KINDS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                              listed(F.col("spans")).alias("spans"))
