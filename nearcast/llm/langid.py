"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of a text's UTF-8 bytes in both directions, labels
every byte position with language probabilities, and a document's probability
is the mean over all its positions. It is trained in numpy by backpropagation
through time on a bounded sample (``train_docs`` documents per language,
``train_windows`` windows of each, at pseudo-random places) of the labelled
documents whose crc32(doc_id) mod 4 is not 2; the rest are held out.
Prediction reads whole texts, many windows at a time, and nothing else.

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text when nothing was learned (no labelled document); a null id is
neither trained on nor held out; ties go to the first language in order of
name; repeated rows are predicted each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from nearcast.session import materialize

UNDETERMINED = "und"
TRAIN_DOCS, TRAIN_WINDOWS = 300, 10
HIDDEN, STEPS, BATCH, LENGTH, RATE = 8, 260, 128, 48, 0.02
#: Bytes a window holds when a text is read, and windows read at once.
WINDOW, ROWS = 128, 4096
PAD = 256
LETTER = regex.compile(r"\p{L}")


def sample(docs: DataFrame, per_language: int = TRAIN_DOCS, windows: int = TRAIN_WINDOWS,
           chars: int = 2 * LENGTH) -> list[tuple[str, str]]:
    """(language, passage) pairs: at most ``per_language * windows`` per language, in a fixed order."""
    fit = (docs.select("lang", "doc_id", "text").where("lang is not null and text is not null and crc32(cast(doc_id as string)) % 4 <> 2")
           .where(F.col("text").rlike(r"\p{L}")))
    ids = fit.select("lang", "doc_id", F.xxhash64("text").alias("th"), (F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / (1 << 30)).alias("u"))
    ids = materialize(ids)
    counts = materialize(ids.groupBy("lang").agg(F.count("*").alias("n")))
    # about twice the wanted documents pass the share, so the ranks below are over bounded groups
    near = ids.join(counts, "lang").where(F.col("u") * F.col("n") < 2 * per_language + 20)
    near = materialize(near.select("lang", "doc_id", "th", "u"))
    ranked = near.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("u", "doc_id", "th")))
    # texts are fetched for the chosen ids alone
    chosen = materialize(ranked.where(F.col("k") <= per_language).select("lang", "doc_id", "th", "k"))
    chosen = fit.withColumn("th", F.xxhash64("text")).join(chosen, ["lang", "doc_id", "th"]).dropDuplicates(["lang", "k"])
    at = F.pmod(F.xxhash64("doc_id", "i"), F.greatest(F.char_length("text") - chars, F.lit(1))) + 1
    cut = (chosen.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(windows))))
           .select("lang", "k", "i", F.expr("text").substr(at.cast("int"), F.lit(chars)).alias("passage")))
    return [(r.lang, r.passage) for r in cut.sort("lang", "k", "i").collect()]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Input tables (one row of gate inputs per byte), recurrent and output weights, two directions.

    Arrays are (direction, feature, batch): every step works on all windows at once.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        n = len(languages)
        self.languages, self.hidden = languages, hidden
        self.weights = {
            "x": rng.normal(0, 0.3, (2, 257, 3 * hidden)), "u": rng.normal(0, hidden ** -0.5, (2, 3 * hidden, hidden)),
            "v": rng.normal(0, hidden ** -0.5, (2, n, hidden)), "c": np.zeros((n, 1))}
        self.weights = {k: w.astype(np.float32) for k, w in self.weights.items()}

    def run(self, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits (position, language, window) of windows of bytes (window, position)."""
        w, h = self.weights, self.hidden
        rows, length = data.shape
        valid = (data != PAD).astype(np.float32)
        full = valid.all(axis=0)
        logits = np.empty((length, len(self.languages), rows), dtype=np.float32)
        logits[:] = w["c"]
        for d in (0, 1):
            table, state = np.ascontiguousarray(w["x"][d].T), np.zeros((h, rows), dtype=np.float32)
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                x = np.take(table, data[:, t], axis=1)
                g = w["u"][d] @ state
                gates = x[:2 * h]
                gates += g[:2 * h]
                np.negative(gates, out=gates)
                np.exp(np.clip(gates, -30, 30, out=gates), out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                z, r = gates[:h], gates[h:]
                pre = x[2 * h:]
                pre += r * g[2 * h:]
                n = np.tanh(pre)
                new = n + z * (state - n)
                if not full[t]:
                    new *= valid[:, t]
                if keep is not None:
                    keep.append((d, t, state, z, r, g[2 * h:], n))
                state = new
                logits[t] += w["v"][d] @ state
        return logits

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross entropy over all positions."""
        w, h = self.weights, self.hidden
        keep: list = []
        logits = self.run(data, keep)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[:, labels, np.arange(len(labels))] -= 1
        p *= (data != PAD).T[:, None, :]
        p /= max(1, int((data != PAD).sum()))
        out = {k: np.zeros_like(v) for k, v in w.items()}
        out["c"] = p.sum(axis=(0, 2))[:, None]
        back, last = np.zeros((h, len(labels)), dtype=np.float32), None
        for d, t, state, z, r, gn, n in reversed(keep):
            if d != last:
                back, last = np.zeros_like(back), d
            ok = (data[:, t] != PAD).astype(np.float32)
            new = (n + z * (state - n)) * ok
            out["v"][d] += p[t] @ new.T
            dh = (back + w["v"][d].T @ p[t]) * ok
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (state - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            dx = np.concatenate([dz, dr, dn])
            dg = np.concatenate([dz, dr, dn * r])
            np.add.at(out["x"][d], data[:, t], dx.T)
            out["u"][d] += dg @ state.T
            back = dh * z + w["u"][d].T @ dg
        return out

    def train(self, data: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH,
              rate: float = RATE, seed: int = 1) -> None:
        """Adam with a linearly falling rate; labels drawn evenly."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        s = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for i in range(1, steps + 1):
            pick = np.array([rng.choice(of[k]) for k in rng.integers(len(of), size=batch)])
            for k, g in self.gradients(data[pick], labels[pick]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                step = rate * (1 - i / (steps + 1)) * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(s[k] / (1 - 0.99 ** i)) + 1e-8)
                self.weights[k] = (self.weights[k] - step).astype(np.float32)

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (window, language) summed over the positions of each window."""
        logits = self.run(data)
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        logits *= (data != PAD).T[:, None, :]
        return logits.sum(axis=0, dtype=np.float64).T


def cut(text: bytes, length: int) -> np.ndarray:
    """The first ``length`` bytes as a row of symbols, padded."""
    out = np.full(length, PAD, dtype=np.int16)
    raw = np.frombuffer(text[:length], dtype=np.uint8)
    out[:len(raw)] = raw
    return out


def fit(docs: DataFrame, **bounds: int) -> Network | None:
    """A network trained on the sample of ``docs``; None without labelled documents."""
    pairs = sample(docs, **bounds)
    languages = sorted({lang for lang, _ in pairs})
    if not languages:
        return None
    network = Network(languages)
    number = {lang: k for k, lang in enumerate(languages)}
    data = np.stack([cut(p.encode("utf-8", "replace"), LENGTH) for _, p in pairs])
    network.train(data, np.array([number[lang] for lang, _ in pairs]))
    return network


def probabilities(network: Network, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mean probabilities (document, language) of the byte ranges [begin, end) of ``raw``."""
    sizes = ends - begins
    per_doc = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    first = np.cumsum(per_doc) - per_doc
    starts = begins[doc] + WINDOW * (np.arange(len(doc)) - first[doc])
    out = np.zeros((len(sizes), len(network.languages)))
    steps = np.arange(WINDOW)
    for i in range(0, len(doc), ROWS):
        at = starts[i:i + ROWS, None] + steps
        inside = at < ends[doc[i:i + ROWS], None]
        data = np.where(inside, raw[np.minimum(at, len(raw) - 1)].astype(np.int16), np.int16(PAD))
        np.add.at(out, doc[i:i + ROWS], network.windows(data))
    return out / np.maximum(sizes, 1)[:, None]


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """All columns of ``docs`` whose names are not taken, with ``lang_pred`` and ``score`` from ``text`` alone."""
    schema = docs.drop("lang_pred", "score").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.schema.get_field_index("text")).cast(pa.large_string())
            offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
            raw = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
            named = np.array([x.is_valid and LETTER.search(x.as_py()) is not None for x in text], dtype=bool)
            pred, score = np.full(len(text), UNDETERMINED, dtype=object), np.zeros(len(text))
            if network is not None and named.any():
                p = probabilities(network, raw, offsets[:-1][named], offsets[1:][named])
                best = p.argmax(axis=1)
                pred[named] = np.array(network.languages, dtype=object)[best]
                score[named] = np.minimum(p.max(axis=1), 1.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score)],
                                             names=[*b.schema.names, "lang_pred", "score"])
    return docs.drop("lang_pred", "score").mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; the network is fitted on the others."""
    network = fit(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False))
    return predict(rows, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
