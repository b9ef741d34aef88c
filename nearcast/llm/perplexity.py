"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, of order four, one per language and one of all
languages (for documents whose language has no model). It counts every n-gram
of the whole text of every trusted row: tasks count the texts they read, Spark
sums these tables by n-gram. The counts, continuation counts, context totals,
discounts and the interpolation of each order with the next lower one are Spark
aggregations and joins over tables that are sharded by n-gram.

The tasks that read the documents hold at most about ``SHARD_ROWS`` rows of the
finished table, besides its n-grams of one and two symbols. A larger table is
cut into shards by the two symbols before the predicted one; each shard's
positions are scored in a pass of their own, from every document's first to its
last character, and the passes' sums are added.

A document's score is its mean negative log probability per character, drawn
towards its language's trusted median by ``prior`` characters, so that a few
words are not judged by chance. A language's threshold is the quantile
``quantile`` of the scores of all its documents labelled good (quality 1; a
toxic text is not trusted for the model, but it is no proof of bad quality),
so that share of them is kept and nothing scored above them passes.

Defined cases: null and empty texts have no score and are not kept; with no
trusted document nothing is scored and every other text is kept; null ids and
languages, repeated rows and languages without trusted text are scored by the
model of all languages; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize

from .minhash import BASE, U64, mix

ORDER = 4
#: Share of each language's documents labelled good that the threshold keeps.
PRIOR, QUANTILE = 60, 0.99
#: Stands before the first character; not a character of any text's XML or JSON form.
START = "\x00"
ALL = "*"
#: Rows of the model that a task holds, and code points of text whose n-grams it counts at once.
SHARD_ROWS, COUNT_BLOCK = 1_000_000, 1 << 20
#: Words of 64 bits of the filter of trusted ids.
FILTER_WORDS = 1 << 23


def likely_among(ids: DataFrame, column: str, most_words: int = FILTER_WORDS) -> Column:
    """A test of ``column`` that holds for all ``ids`` and for few other values: a Bloom filter of two bits an id.

    It keeps texts out of a shuffle join; beyond ``most_words`` words it lets more of them pass.
    """
    words = min(max(1, ids.count() // 4), most_words)
    h = F.xxhash64(column)
    bits = [F.expr(f"shiftleft(1L, cast(shiftright(xxhash64({column}), {at}) & 63 as int))") for at in (40, 50)]
    set_bits = ids.groupBy(F.pmod(h, F.lit(words)).alias("word")).agg(F.bit_or(bits[0].bitwiseOR(bits[1])).alias("bits")).toPandas()
    table = np.zeros(words, dtype=np.int64)
    table[set_bits["word"].to_numpy(dtype=np.int64)] = set_bits["bits"].to_numpy(dtype=np.int64)

    @F.pandas_udf("boolean")
    def test(word: pd.Series, bits: pd.Series) -> pd.Series:
        bits = bits.to_numpy()
        return pd.Series(table[word.to_numpy()] & bits == bits)
    return test(F.pmod(h, F.lit(words)), bits[0].bitwiseOR(bits[1]))


def trusted_texts(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, text: the whole padded texts of all trusted rows."""
    good = materialize(labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct())
    known = docs.where("lang is not null and text is not null and char_length(text) > 0").where(likely_among(good, "doc_id"))
    # a merge join at every size: what tasks hold does not grow with the labels
    return known.join(good.hint("merge"), "doc_id", "left_semi").select(
        "lang", F.concat(F.lit(START * (order - 1)), F.col("text")).alias("text"))


def count_windows(codes: np.ndarray, inside: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The different windows of ``order`` symbols at the places ``inside``, one a row, and how often each occurs."""
    symbols, number = np.unique(codes, return_inverse=True)
    bits = max(1, int(len(symbols) - 1).bit_length())
    if bits * order > 64:  # too many symbols for one word: tell the windows apart as rows
        return np.unique(np.stack([codes[k:len(codes) - order + 1 + k] for k in range(order)], axis=1)[inside], axis=0, return_counts=True)
    wide = np.uint32 if bits * order <= 32 else np.uint64
    number = number.astype(wide)
    key = np.zeros(len(codes) - order + 1, dtype=wide)
    for k in range(order):
        key = (key << wide(bits)) | number[k:len(codes) - order + 1 + k]
    key, count = np.unique(key[inside], return_counts=True)
    return np.stack([symbols[(key >> wide(bits * k)) & wide((1 << bits) - 1)] for k in range(order - 1, -1, -1)], axis=1), count


def gram_counts(texts: DataFrame, order: int = ORDER, block: int = COUNT_BLOCK) -> DataFrame:
    """lang, gram, c: how often each n-gram of ``order`` symbols occurs in whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("lang").to_numpy(zero_copy_only=False)
            for lang in set(langs):
                mine = b.column("text").take(pa.array(np.flatnonzero(langs == lang))).to_pylist()
                ends = np.cumsum([len(t) for t in mine])
                codes = np.frombuffer("".join(mine).encode("utf-32-le"), dtype="<u4")
                inside = np.ones(len(codes), dtype=bool)
                for k in range(1, order):  # no window reaches into the next text
                    inside[ends[ends >= k] - k] = False
                for i in range(0, len(codes) - order + 1, block):
                    part = codes[i:i + block + order - 1]
                    grams, count = count_windows(part, inside[i:i + len(part) - order + 1], order)
                    joined = grams.astype("<u4").tobytes().decode("utf-32-le")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(count), pa.string()), pa.array([joined[j:j + order] for j in range(0, len(joined), order)], pa.string()),
                         pa.array(count, pa.int64())], names=["lang", "gram", "c"])
    rows = texts.select(F.col("lang").cast("string").alias("lang"), "text")
    return rows.mapInArrow(run, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def kneser_ney(texts: DataFrame, order: int = ORDER, pooled: str | None = None) -> DataFrame:
    """lang, gram, kind, value: log probability of every seen n-gram ('p') and log weight of every context ('g').

    With ``pooled`` there is one more model of that name, of the texts of all languages.
    """
    counts = {order: materialize(gram_counts(texts, order))}
    if pooled is not None:
        counts[order] = counts[order].unionByName(
            counts[order].groupBy("gram").agg(F.sum("c").alias("c")).select(F.lit(pooled).alias("lang"), "gram", "c"))
    for n in range(order - 1, 0, -1):
        # how many different symbols come before it
        counts[n] = materialize(counts[n + 1].groupBy("lang", F.expr(f"substring(gram, 2, {n})").alias("gram")).agg(F.count("*").alias("c")))
    symbols = counts[1].groupBy("lang").agg((F.count("*") + 1).alias("symbols"))
    lower = None
    out = []
    for n in range(1, order + 1):
        of = [F.count(F.when(F.col("c") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
        d = counts[n].groupBy("lang").agg(*of).withColumn("y", F.coalesce(F.try_divide("n1", F.col("n1") + 2 * F.col("n2")), F.lit(0.5)))
        for k in (1, 2, 3):
            # the usual estimate, kept inside (0, k) where counts of counts are missing
            guess = F.lit(float(k)) - (k + 1) * F.col("y") * F.coalesce(F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(0.5))
            d = d.withColumn(f"d{k}", F.least(F.greatest(guess, F.lit(0.05)), F.lit(k - 0.05)))
        d = d.select("lang", "d1", "d2", "d3")
        rows = counts[n].withColumn("h", F.expr(f"substring(gram, 1, {n - 1})"))
        contexts = rows.groupBy("lang", "h").agg(
            F.sum("c").alias("total"), *(F.count(F.when(test, 1)).alias(f"k{k}") for k, test in
                                         ((1, F.col("c") == 1), (2, F.col("c") == 2), (3, F.col("c") >= 3)))).join(d, "lang")
        contexts = contexts.withColumn("gamma", (F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total"))
        discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = (F.col("c") - discount) / F.col("total")
        joined = rows.join(contexts, ["lang", "h"])
        if n == 1:
            joined = joined.join(symbols, "lang").withColumn("p", own + F.col("gamma") / F.col("symbols"))
        else:
            suffix = joined.withColumn("s", F.expr(f"substring(gram, 2, {n - 1})"))
            joined = suffix.join(lower.select("lang", F.col("gram").alias("s"), F.col("p").alias("q")), ["lang", "s"]) \
                .withColumn("p", own + F.col("gamma") * F.col("q"))
        lower = materialize(joined.select("lang", "gram", "p"))
        out.append(lower.select("lang", "gram", F.lit("p").alias("kind"), F.log("p").alias("value")))
        weight = F.log("gamma")
        if n == 1:  # the empty context also spreads its weight over the symbols: what an unseen symbol gets
            contexts = contexts.join(symbols, "lang")
            weight = F.log(F.col("gamma") / F.col("symbols"))
        out.append(contexts.select("lang", F.col("h").alias("gram"), F.lit("g").alias("kind"), weight.alias("value")))
    table = out[0]
    for t in out[1:]:
        table = table.unionByName(t)
    return table


def key_of(codes: list[np.ndarray]) -> np.ndarray:
    """Hash of the n-grams whose symbols are given, oldest first."""
    key = np.full(len(codes[0]), len(codes), dtype=np.uint64)
    for c in codes:
        key = (key + c) * BASE
        key ^= key >> U64(29)
    return mix(key)


class Table:
    """Open addressing over numpy arrays: 64-bit key to value, NaN if absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.mask = U64((1 << max(4, math.ceil(math.log2(max(len(keys), 1) * 2.5)))) - 1)
        self.keys = np.zeros(int(self.mask) + 1, dtype=np.uint64)
        self.values = np.full(int(self.mask) + 1, np.nan)
        todo = np.arange(len(keys))
        step = U64(0)
        while len(todo):
            slot = ((keys[todo] + step) & self.mask).astype(np.int64)
            free = self.keys[slot] == 0
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            put = np.zeros(len(todo), dtype=bool)
            put[first] = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[todo[put]], values[todo[put]]
            todo = todo[~put]
            step += U64(1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys & self.mask).astype(np.int64)
        at = self.keys[slot]
        out = np.where(at == keys, self.values[slot], np.nan)
        todo = np.flatnonzero((at != keys) & (at != 0))
        while len(todo):
            slot = ((slot if len(slot) == len(todo) else slot[todo]) + 1) & int(self.mask)
            at = self.keys[slot]
            found = at == keys[todo]
            out[todo[found]] = self.values[slot[found]]
            go = ~found & (at != 0)
            todo, slot = todo[go], slot[go]
        return out


def shard_of(before: np.ndarray, last: np.ndarray, shards: int) -> np.ndarray:
    """The shard of positions whose two preceding symbols are given."""
    return (before.astype(np.int64) * 31_337 + last.astype(np.int64)) % shards


def in_shard(shard: int, shards: int) -> Column:
    """Whether a row of the table belongs to a shard; those of all positions after a symbol belong to every one."""
    seen = F.col("kind") == "p"
    n = F.char_length("gram")
    at = n - F.when(seen, 2).otherwise(1)  # the two symbols before the predicted one
    first, second = (F.ascii(F.col("gram").substr(at + k, F.lit(1))).cast("long") for k in (0, 1))
    return (at < 1) | ((first * 31_337 + second) % shards == shard)


def symbols_of(grams: pa.ChunkedArray) -> np.ndarray:
    """Code points of all strings, one string after the other; no Python string is made of each."""
    out = []
    for a in grams.cast(pa.string()).chunks:
        ends = np.frombuffer(a.buffers()[1], dtype=np.int32)[a.offset:a.offset + len(a) + 1]
        if len(a) and ends[-1] > ends[0]:
            out.append(bytes(a.buffers()[2][int(ends[0]):int(ends[-1])]).decode().encode("utf-32-le"))
    return np.frombuffer(b"".join(out), dtype="<u4")


class Model:
    """Tables of one language, or of one shard of it."""

    def __init__(self, rows: pa.Table | list[tuple[str, str, float]], order: int = ORDER, shard: int = 0, shards: int = 1):
        self.order, self.shard, self.shards = order, shard, shards
        self.p: dict[int, Table] = {}
        self.g: dict[int, Table] = {}
        if not isinstance(rows, pa.Table):
            rows = pa.table(dict(zip(("gram", "kind", "value"), zip(*rows, strict=True), strict=True)))
        for kind, into in (("p", self.p), ("g", self.g)):
            of = rows.filter(pc.equal(rows["kind"], kind))
            long = pc.utf8_length(of["gram"])
            for n in pc.unique(long).to_pylist():
                part = of.filter(pc.equal(long, n))
                if n:
                    codes = symbols_of(part["gram"]).reshape(-1, n).astype(np.uint64)
                    into[n] = Table(key_of(list(codes.T)), part["value"].to_numpy())
                elif kind == "g":
                    self.unseen = part["value"][0].as_py()

    def score(self, text: np.ndarray) -> np.ndarray:
        """Log probability of each code point of the padded text, after the padding (0 where another shard has it)."""
        n = len(text) - self.order + 1
        out = np.zeros(n)
        todo = np.arange(n) + self.order - 1
        if self.shards > 1:
            todo = todo[shard_of(text[todo - 2], text[todo - 1], self.shards) == self.shard]
        for m in range(self.order, 0, -1):
            if m not in self.p:  # none in this shard
                found = np.full(len(todo), np.nan)
            else:
                found = self.p[m].get(key_of([text[todo - k] for k in range(m - 1, -1, -1)]))
            seen = ~np.isnan(found)
            out[todo[seen] - self.order + 1] += found[seen]
            todo = todo[~seen]
            if not len(todo):
                break
            if m > 1 and m - 1 in self.g:
                weight = self.g[m - 1].get(key_of([text[todo - k] for k in range(m - 1, 0, -1)]))
                out[todo - self.order + 1] += np.nan_to_num(weight, nan=0.0)
            elif m == 1:
                out[todo - self.order + 1] += self.unseen
        return out


def scores(docs: DataFrame, models: dict[str, Model], block: int = 1 << 18) -> DataFrame:
    """doc_id, lang, n_symbols, total (negative log probability) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.zeros(ORDER - 1, dtype=np.uint64)
        for b in batches:
            totals, sizes = [], []
            for lang, text in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                text = text.as_py() or ""
                model = models.get(lang) or models.get(ALL)
                codes = np.concatenate([pad, np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)])
                total = 0.0
                if model and text:
                    for i in range(0, len(text), block):  # a block's history is the end of the one before
                        total -= float(model.score(codes[i:i + block + ORDER - 1]).sum())
                totals.append(total)
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(totals, pa.float64())],
                                             names=["doc_id", "lang", "n_symbols", "total"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang string, n_symbols long, total double")


def shard_models(table: DataFrame, shard: int, shards: int) -> dict[str, Model]:
    """One shard's part of every model."""
    rows = table.where(in_shard(shard, shards)) if shards > 1 else table
    rows = rows.select("lang", "gram", "kind", "value").toArrow()
    return {lang: Model(rows.filter(pc.equal(rows["lang"], lang)), shard=shard, shards=shards) for lang in pc.unique(rows["lang"]).to_pylist()}


def scores_by_shards(docs: DataFrame, table: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, list[str]]:
    """What ``scores`` returns, by the models of a finished table, and their names."""
    shards = max(1, -(-table.count() // shard_rows))
    names = sorted(r.lang for r in table.where("gram = ''").select("lang").collect())
    if shards == 1:
        return materialize(scores(docs, shard_models(table, 0, 1))), names
    # rows may look alike, so each has a number; every pass reads the rows as they are numbered here
    docs = materialize(docs.select("doc_id", "lang", "text").withColumn("uid", F.monotonically_increasing_id()))
    parts = []
    for shard in range(shards):  # one pass at a time, so that a task holds one shard
        numbered = docs.select(F.col("uid").alias("doc_id"), "lang", "text")
        parts.append(materialize(scores(numbered, shard_models(table, shard, shards)).withColumnRenamed("doc_id", "uid")))
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    total = total.groupBy("uid").agg(F.first("n_symbols").alias("n_symbols"), F.sum("total").alias("total"))
    own = docs.select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    return materialize(own.join(total, "uid").select("doc_id", "lang", "n_symbols", "total")), names


def classify(docs: DataFrame, labels: DataFrame, prior: int = PRIOR, quantile: float = QUANTILE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, score, threshold, kept of every row."""
    table = materialize(kneser_ney(trusted_texts(docs, labels), pooled=ALL))
    read, models = scores_by_shards(docs, table, shard_rows)
    read = read.withColumn("model", F.when(F.col("lang").isin(*models), F.col("lang")).otherwise(F.lit(ALL)))
    mean = F.try_divide("total", "n_symbols")
    labelled = labels.where("quality = 1").groupBy("doc_id").agg((F.min(F.coalesce("toxic", F.lit(0))) == 0).alias("trusted"))
    good = read.where("n_symbols > 0").join(labelled, "doc_id").select(
        F.explode(F.array("model", F.lit(ALL))).alias("model"), "n_symbols", "total", "trusted").where(F.lit(bool(models)))
    middle = materialize(good.where("trusted").groupBy("model").agg(F.percentile_approx(mean, 0.5, F.lit(10000)).alias("middle")))
    drawn = (F.col("total") + prior * F.col("middle")) / (F.col("n_symbols") + prior)
    limits = materialize(good.join(middle, "model").withColumn("score", drawn).groupBy("model").agg(
        F.first("middle").alias("middle"), F.percentile_approx("score", quantile, F.lit(10000)).alias("threshold")))
    judged = read.join(limits, "model", "left").withColumn("score", F.when(F.col("n_symbols") > 0, drawn))
    return judged.select(
        "doc_id", "lang", "n_symbols", F.when(F.col("threshold").isNotNull(), F.exp(mean)).alias("perplexity"), "score", "threshold",
        ((F.col("n_symbols") > 0) & F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True))).alias("kept"))
