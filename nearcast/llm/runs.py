"""Runs of periodic words by an online diagonal DP over sparse lags.

A run is a stretch of consecutive words in which words ``period`` apart are
identical (the smallest such period), of at least ``max(6, 4 * period)`` words,
that no neighbouring word extends.

The words of a text are read once, in order. For every word, its earlier
occurrences increment the match length of their lag (the diagonal of word
number minus lag); lags that the word does not continue end, and an ended
diagonal that is long enough emits its run at once. Only lags that are active
are stored.

A frequent word would have as many active lags as occurrences. Therefore lags
of 2^k up to 2^(k+1) - 1 are stepped in words of 2^k: at every 2^k-th place,
the earlier occurrences of the next 2^k words within those lags increment. A
run with a period of 2^k or more repeats itself over three periods, so its
diagonal has at least two consecutive steps, and what it has beyond its
steps is compared word by word. Each k so costs at most as many increments as
the text has words, whatever repeats: n log n for a text of n words, where the
plain DP is quadratic in a text of one repeated word. Where no 2^k words
occur twice, no longer lag can have a run and the search ends.

Texts are independent rows: a task holds one text's words at a time.

Defined cases: words are separated by ASCII white space and compared as they
are written; null and empty texts have no words and no runs; repeated rows and
null ids are rows like others; an empty table gives no row; only the id and
the text column are read.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def joined(grams: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the grams of twice the size (``grams``: numbers of the grams of ``size`` words at each place)."""
    left, right = grams[:-size], grams[size:]
    return np.unique(left * (int(grams.max()) + 1) + right, return_inverse=True)[1] if len(left) else left


def extended(words: np.ndarray, lag: int, first: int, last: int) -> tuple[int, int]:
    """The whole diagonal (first place, place after the last) that matches at ``lag`` around [first, last)."""
    lo, step = first, 64
    while lo > lag:
        cut = max(lag, lo - step)
        differs = np.flatnonzero(words[cut:lo] != words[cut - lag:lo - lag])
        if len(differs):
            lo = cut + int(differs[-1]) + 1
            break
        lo, step = cut, step * 2
    hi, step, n = last, 64, len(words)
    while hi < n:
        cut = min(n, hi + step)
        differs = np.flatnonzero(words[hi:cut] != words[hi - lag:cut - lag])
        if len(differs):
            hi += int(differs[0])
            break
        hi, step = cut, step * 2
    return lo, hi


def repeated_within(grams: np.ndarray, distance: int) -> tuple[np.ndarray, bool]:
    """Places whose gram stands again less than ``distance`` away, ascending; whether any gram occurs twice at all."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    near = same & (order[1:] - order[:-1] < distance)
    marked = np.zeros(len(grams), dtype=bool)
    marked[order[1:][near]] = marked[order[:-1][near]] = True
    return np.flatnonzero(marked), bool(same.any())


def diagonals(words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, length, lag) of every stretch that is long enough for its lag; lags of one step size as they end."""
    grams, size, n = words, 1, len(words)
    while n >= max(LEAST_WORDS, LEAST_PERIODS * size):
        places, any_twice = repeated_within(grams, 2 * size)
        if not any_twice:
            return
        symbols = grams[places].tolist()
        places = places.tolist()
        seen: defaultdict[int, deque[int]] = defaultdict(deque)
        active: dict[int, int] = {}  # lag -> place where its current match began
        entered, expected = 0, 0
        for at, symbol in zip(places, symbols, strict=True):
            if at % size:
                continue
            if at > expected:  # steps between without an earlier occurrence
                for lag, first in active.items():
                    yield from ended(words, lag, first, expected, size)
                active = {}
            # what begins at least ``size`` words back is an earlier occurrence from now on
            while places[entered] <= at - size:
                seen[symbols[entered]].append(places[entered])
                entered += 1
            now: dict[int, int] = {}
            if earlier := seen.get(symbol):
                while earlier and at - earlier[0] >= 2 * size:  # a longer step's lag
                    earlier.popleft()
                for j in earlier:
                    now[at - j] = active.pop(at - j, at)
            for lag, first in active.items():
                yield from ended(words, lag, first, at, size)
            active, expected = now, at + size
        for lag, first in active.items():
            yield from ended(words, lag, first, expected, size)
        grams, size = joined(grams, size), size * 2


def ended(words: np.ndarray, lag: int, first: int, last: int, size: int) -> Iterator[tuple[int, int, int]]:
    """The stretch of a diagonal that matched in the steps [first, last), if it is long enough."""
    if last - first < 2 * size and size > 1:
        return
    lo, hi = extended(words, lag, first, last)
    length = hi - lo + lag
    if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
        yield lo - lag, length, lag


def runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period.

    A stretch that repeats with a period also does so with its multiples: of
    equal stretches only the smallest lag is the period.
    """
    period: dict[tuple[int, int], int] = {}
    for start, length, lag in diagonals(words):
        key = (start, length)
        period[key] = min(lag, period.get(key, lag))
    return sorted((start, length, lag) for (start, length), lag in period.items())


def first_periods(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut to its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, lag in found:
        edge[start + lag] += 1
        edge[start + length] -= 1
    return np.cumsum(edge)[:n] == 0


FOUND = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``runs`` (by start, then period) and ``collapsed`` (kept words joined by one space) of every row."""
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for text in batch.column(1).cast(pa.large_binary()):
                words = (text.as_py() or b"").split()  # of bytes: splits at ASCII white space only
                rows = runs(word_numbers(words)) if len(words) >= LEAST_WORDS else []
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in rows])
                if rows:
                    words = [words[i] for i in np.flatnonzero(first_periods(len(words), rows))]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind), pa.array(kept, pa.large_string()).cast(pa.string())],
                                             names=[id_col, "runs", "collapsed"])
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return rows.mapInArrow(task, f"`{id_col}` long, {FOUND}")


def strongest(found: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties: the first in the array. Null without runs."""
    def better(best: Column, run: Column) -> Column:
        return F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)
    return F.aggregate(found, F.get(found, F.lit(0)), better)


def echoed(docs: DataFrame) -> DataFrame:
    """Documents whose id's CRC-32 ends in 0 repeat themselves: from word ``a`` on they go on with their words a..a+p-1."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", WORD_SPLIT, -1), lambda w: w != "")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(chosen, words).alias("words"))
    n = F.size("words")
    a = F.when(n > 0, F.col("g") % n)
    rows = rows.withColumn("a", a).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))

    def word(i: Column) -> Column:
        return F.get("words", F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int"))
    altered = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return rows.select("doc_id", F.when(n > 0, altered).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """Number of runs, the strongest one and digests of all of them and of the collapsed text, per document."""
    best = strongest(F.col("runs")).alias("best")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    found = periodic(echoed(docs)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best, F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                        F.floor(F.lit(1000).cast("long") * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                        "runs_sha256", "collapsed_sha256")
