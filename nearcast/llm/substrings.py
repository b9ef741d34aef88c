"""Exact removal of repeated 200-byte strings with suffix arrays.

Every 200-byte window of a text belongs to its anchor, the 64-byte string in it
with the smallest hash, so equal windows have equal anchors wherever they are.
Consecutive windows with one anchor are a run. Only runs whose anchor occurs
twice in the corpus can hold a repeated window, and equal runs answer for each
other without being read again. Runs that differ although their anchor is the
same go to shards by anchor: a shard's suffix array is built by
Larsson-Sadakane refinement in numpy (only groups that are still unsorted are
sorted again, at doubled depth), Kasai's rule gives the common prefixes, and
windows with a neighbour at 200 or more are repeated.

An anchor with very many different runs is dealt over several shards. Each cuts
its sorted window digests at fixed bounds by binary search, and one task per
anchor and range merges the slices, again by binary search, so that no task
holds all windows of an anchor.

Defined cases: a null text is empty; texts under 200 bytes lose nothing; rows
with equal id and text are occurrences of their own (their windows repeat) and
get the same result; null ids are kept apart by their text; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize

from .minhash import BASE, U64, mix

LENGTH, ANCHOR = 200, 64
#: Bytes to which suffixes are sorted: the first doubling of eight beyond a window.
DEPTH = 256
#: Window starts that an anchor can serve.
REACH = LENGTH - ANCHOR + 1
#: Bytes hashed at once (positions must fit into PLACE bits), bytes of runs in a shard, different runs of an anchor in one shard.
CHUNK, PLACE = 1 << 19, 20
SHARD_BYTES, SHARD_RUNS = 2 << 20, 4000
NO_ID = -(1 << 63)


def doubled(raw: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the 64- and 128-byte strings at each position (short at the end)."""
    g, size, out = mix(raw.astype(np.uint64) + BASE), 1, {}
    while size < 128:
        g = g[:len(g) - size] * U64((0x9E3779B97F4A7C15 ^ (size * 0x2545F4914F6CDD1D)) & 0xFFFFFFFFFFFFFFFF | 1) + g[size:]
        size *= 2
        if size in (64, 128):
            out[size] = mix(g)
            g = out[size]
    return out


def window_hashes(h128: np.ndarray) -> np.ndarray:
    return mix(h128[:len(h128) - (LENGTH - 128)] * BASE + h128[LENGTH - 128:])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:len(v) - size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def runs_of(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of the texts at [begin, end) of one chunk: text number, anchor hash, start in the text, windows, digest."""
    starts = len(raw) - LENGTH + 1
    if starts <= 0:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    h = doubled(raw)
    text = np.searchsorted(ends, np.arange(starts), side="right")
    valid = np.arange(starts) + LENGTH <= ends[text]
    low = U64((1 << PLACE) - 1)
    packed = (h[64] & ~low) | np.arange(len(h[64]), dtype=np.uint64)
    anchor = (sliding_min(packed, REACH) & low).astype(np.int64)[:starts]
    new = np.flatnonzero(valid & np.r_[True, (anchor[1:] != anchor[:-1]) | ~valid[:-1] | (text[1:] != text[:-1])])
    stop = np.flatnonzero(valid & np.r_[(anchor[1:] != anchor[:-1]) | ~valid[1:] | (text[1:] != text[:-1]), True])
    whole = window_hashes(h[128])
    n = stop - new + 1
    digest = mix(mix(whole[new] * BASE + whole[stop]) + n.astype(np.uint64))
    return text[new], h[64][anchor[new]], new - begins[text[new]], n, digest


def chunks(sizes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(from, to, text, begin, end, shift): byte ranges to hash at once; long texts are cut, overlapping by a window."""
    i = 0
    while i < len(sizes):
        if sizes[i] > CHUNK:
            for at in range(0, int(sizes[i]) - LENGTH + 1, CHUNK - LENGTH + 1):
                size = min(CHUNK, int(sizes[i]) - at)
                yield (int(offsets[i]) + at, int(offsets[i]) + at + size, np.array([i]), np.array([0]), np.array([size]), np.array([at]))
            i += 1
            continue
        j = i + 1
        while j < len(sizes) and offsets[j] + sizes[j] - offsets[i] <= CHUNK:
            j += 1
        begin = offsets[i:j] - offsets[i]
        yield int(offsets[i]), int(offsets[j - 1] + sizes[j - 1]), np.arange(i, j), begin, begin + sizes[i:j], np.zeros(j - i, np.int64)
        i = j


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    text = column.cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    return np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8), offsets[:-1], np.diff(offsets)


def keyed(docs: DataFrame) -> DataFrame:
    """id (null: the smallest long), th (hash of the text), text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def find_runs(rows: DataFrame) -> DataFrame:
    """id, th, anchor, start, n, digest of every run of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets, sizes = text_bytes(b.column(2))
            ids, hashes = b.column(0).to_numpy(), b.column(1).to_numpy()
            for at, end, number, begin, stop, shift in chunks(sizes, offsets):
                text, anchor, start, n, digest = runs_of(raw[at:end], begin, stop)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[number[text]]), pa.array(hashes[number[text]]), pa.array(anchor.view(np.int64)),
                     pa.array(start + shift[text]), pa.array(n.astype(np.int32)), pa.array(digest.view(np.int64))],
                    names=["id", "th", "anchor", "start", "n", "digest"])
    return rows.mapInArrow(run, "id long, th long, anchor long, start long, n int, digest long")


def suffix_array(data: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions in the order of their suffixes' first ``depth`` bytes (ties in order of position).

    Larsson-Sadakane: after the order by eight bytes, a suffix's rank is its
    group's; groups of one are done, the others are sorted by the rank of the
    suffix as many bytes further on as the order is deep, and split.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        word = (word << U64(8)) | padded[k:n + k]
    order = np.argsort(word, kind="stable")
    new = np.r_[True, word[order][1:] != word[order][:-1]] if n else np.zeros(0, bool)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    first = np.flatnonzero(new)
    group = np.repeat(first, np.diff(np.r_[first, n]))
    rank[order] = group
    size = 8
    open_at = np.flatnonzero(np.diff(np.r_[first, n])[np.cumsum(new) - 1] > 1) if n else first
    while len(open_at) and size < depth:
        at = order[open_at]
        further = rank[np.minimum(at + size, n)]
        key = rank[at] * (n + 2) + further + 1
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_at] = at
        new = np.r_[True, key[1:] != key[:-1]]
        first = np.flatnonzero(new)
        sizes = np.diff(np.r_[first, len(at)])
        rank[at] = np.repeat(open_at[first], sizes)
        open_at = open_at[np.repeat(sizes, sizes) > 1]
        size *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int = DEPTH, lanes: int = 4096) -> np.ndarray:
    """Common prefix of each suffix with its predecessor in ``order``, up to ``most``, by Kasai's rule.

    The prefix at position i + 1 is at least that at i less one, unless the two
    suffixes at i agree to the depth of the order, which then says nothing about
    what follows. Positions are read in lanes side by side, each in order; eight
    bytes are compared at once.
    """
    n = len(data)
    out = np.zeros(n, dtype=np.int64)
    if n < 2:
        return out
    before = np.empty(n, dtype=np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(most + 16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(padded) - 7,), (1,))
    steps = -(-n // lanes)
    start = np.arange(0, n, steps)
    have = np.zeros(len(start), dtype=np.int64)
    for s in range(steps):
        i = start + s
        live = i < n
        i = i[live]
        j = before[i]
        length = np.where(j < 0, 0, np.maximum(have[live] - 1, 0))
        go = np.flatnonzero((j >= 0) & (length < most))
        while len(go):
            x = words[i[go] + length[go]] ^ words[j[go] + length[go]]
            equal = x == 0
            length[go[equal]] += 8
            differ = go[~equal]
            x = x[~equal]
            low = x & (~x + U64(1))
            length[differ] += np.frexp(low.astype(np.float64))[1].astype(np.int64) - 1 >> 3
            go = go[equal]
            go = go[length[go] < most]
        length = np.minimum(length, np.minimum(most, n - np.maximum(i, j)))
        out[i] = length
        have[live] = np.where(length < most, length, 0)
    return out[order]


def covers(starts: np.ndarray, repeated: np.ndarray) -> tuple[list[int], list[int]]:
    """Byte ranges covered by the repeated windows (ascending starts) of one run."""
    at = starts[repeated]
    if not len(at):
        return [], []
    new = np.flatnonzero(np.r_[True, np.diff(at) > LENGTH])
    return at[new].tolist(), (at[np.r_[new[1:] - 1, len(at) - 1]] + LENGTH).tolist()


def repeated_windows(texts: list[bytes], multiple: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of a shard's runs: run, offset, whether repeated, digest."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = sizes - LENGTH + 1
    run = np.repeat(np.arange(len(texts)), n)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    place = (np.cumsum(sizes) - sizes)[run] + offset
    window = np.zeros(len(data), dtype=bool)
    window[place] = True
    order = suffix_array(data)
    prefix = common_prefixes(data, order)
    # suffixes that are no window (they leave their run) may stand between; a class needs two windows
    group = np.cumsum(prefix < LENGTH) - 1
    count = np.bincount(group, weights=window[order])
    of = np.empty(len(data), dtype=np.int64)
    of[order] = group
    repeated = (count[of[place]] > 1) | multiple[run]
    return run, offset, repeated, window_hashes(doubled(data)[128])[place]


SPANS = "id long, th long, begin long, end long"


def shard_task(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spans of one shard; of an anchor dealt over several shards also its windows' digests in ranges."""
    texts = pdf["bytes"].tolist()
    multiple = pdf["copies"].to_numpy() > 1
    run, offset, repeated, digest = repeated_windows(texts, multiple)
    parts = int(pdf["parts"].iat[0])
    rows = []
    edges = np.flatnonzero(np.r_[True, run[1:] != run[:-1], True])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        k = run[a]
        if not multiple[k]:
            base = int(pdf["start"].iat[k])
            rows += [(int(pdf["id"].iat[k]), int(pdf["th"].iat[k]), base + s, base + e, *[None] * 6)
                     for s, e in zip(*covers(offset[a:b], repeated[a:b]), strict=True)]
    if parts > 1:
        order = np.argsort(digest, kind="stable")
        bounds = np.searchsorted(digest[order], (np.arange(1, parts, dtype=np.uint64) * U64((1 << 64) // parts)))
        for r, part in enumerate(np.split(order, bounds)):
            if len(part):
                owner = pdf.iloc[run[part]]
                rows.append((None, None, None, None, int(pdf["anchor"].iat[0]), r, digest[part].view(np.int64).tolist(),
                             owner["id"].tolist(), owner["th"].tolist(), (owner["start"].to_numpy() + offset[part]).tolist()))
    # objects, not floats: 64-bit keys stand beside missing values
    return pd.DataFrame(rows, columns=["id", "th", "begin", "end", "anchor", "part", "digests", "ids", "hashes", "places"], dtype=object)


def merge_task(pdf: pd.DataFrame) -> pd.DataFrame:
    """Windows that two shards of an anchor have in one range of digests."""
    slices = [np.array(d, dtype=np.int64).view(np.uint64) for d in pdf["digests"]]
    rows = []
    for k, own in enumerate(slices):
        found = np.zeros(len(own), dtype=bool)
        for other in slices[:k] + slices[k + 1:]:
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            found |= other[at] == own
        ids, hashes, places = pdf["ids"].iat[k], pdf["hashes"].iat[k], pdf["places"].iat[k]
        rows += [(int(ids[i]), int(hashes[i]), int(places[i]), int(places[i]) + LENGTH) for i in np.flatnonzero(found)]
    return pd.DataFrame(rows, columns=["id", "th", "begin", "end"], dtype=object)


def spans(rows: DataFrame) -> DataFrame:
    """id, th, begin, end: byte ranges whose union is what repeated windows cover."""
    found = materialize(find_runs(rows))
    again = materialize(found.groupBy("anchor").agg(F.count("*").alias("seen")).where("seen > 1").select("anchor"))
    found = materialize(found.join(again, "anchor"))
    whose = F.struct("id", "th", "start")
    distinct = materialize(found.groupBy("anchor", "n", "digest").agg(F.count("*").alias("copies"), F.min(whose).alias("one")))
    # runs with copies are repeated from end to end
    copied = found.join(distinct.where("copies > 1").select("anchor", "n", "digest"), ["anchor", "n", "digest"]).select(
        "id", "th", F.col("start").alias("begin"), (F.col("start") + F.col("n") + LENGTH - 1).alias("end"))

    mixed = materialize(distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    wanted = distinct.join(mixed, "anchor").select("anchor", "kinds", "copies", F.col("n"), "one.*")
    wanted = materialize(wanted)
    size = wanted.agg(F.sum(F.col("n") + LENGTH - 1)).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    parts = F.ceil(F.col("kinds") / SHARD_RUNS).cast("int")
    per_text = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("anchor", "copies", parts.alias("parts"), "n", "start")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            raw, offsets, _ = text_bytes(b.column(2))
            for k, (i, th, wanted_runs) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 1, 3)), strict=True)):
                for r in wanted_runs:
                    at = int(offsets[k]) + r["start"]
                    row = (i, th, r["anchor"], r["copies"], r["parts"], r["start"], raw[at:at + r["n"] + LENGTH - 1].tobytes())
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
            kinds = (*[pa.int64()] * 4, pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                             names=["id", "th", "anchor", "copies", "parts", "start", "bytes"])
    texts = rows.where(F.octet_length("text") >= LENGTH).join(per_text, ["id", "th"]).select("id", "th", "text", "runs")
    cut_runs = texts.mapInArrow(cut, "id long, th long, anchor long, copies long, parts int, start long, bytes binary")
    # rows with equal id and text give the same run twice; one is enough, its copies are counted
    shard = F.when(F.col("parts") > 1, F.xxhash64("anchor", F.pmod(F.xxhash64("id", "th", "start"), F.col("parts").cast("long")))) \
        .otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    alone = F.when(F.col("parts") > 1, F.col("anchor"))
    pieces = cut_runs.dropDuplicates(["id", "th", "anchor", "start"]).withColumns({"shard": shard, "alone": alone})
    sharded = materialize(pieces.groupBy("shard", "alone").applyInPandas(
        lambda pdf: shard_task(pdf), SPANS + ", anchor long, part int, digests array<long>, "
        "ids array<long>, hashes array<long>, places array<long>"))
    merged = sharded.where("anchor is not null").groupBy("anchor", "part").applyInPandas(lambda pdf: merge_task(pdf), SPANS)
    return copied.unionByName(sharded.where("begin is not null").select("id", "th", "begin", "end")).unionByName(merged)


def united(begins: list[int], ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The union of byte ranges as disjoint ranges that do not touch."""
    order = np.argsort(begins, kind="stable")
    b, e = np.array(begins, dtype=np.int64)[order], np.maximum.accumulate(np.array(ends, dtype=np.int64)[order])
    new = np.flatnonzero(np.r_[True, b[1:] > e[:-1]])
    return b[new], e[np.r_[new[1:] - 1, len(b) - 1]]


def without(text: bytes, begins: np.ndarray, ends: np.ndarray) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *ends], [*begins, len(text)], strict=True))


def per_text_spans(rows: DataFrame) -> DataFrame:
    found = materialize(spans(rows).distinct())
    return materialize(found.groupBy("id", "th").agg(F.collect_list(F.struct("begin", "end")).alias("spans")))


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = keyed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, text, found in zip(b.column(0).to_pylist(), b.column(2), b.column(3), strict=True):
                data = text.as_py().encode()
                found = found.as_py() or []
                begins, ends = united([s["begin"] for s in found], [s["end"] for s in found]) if found else (np.zeros(0, int),) * 2
                kept = without(data, begins, ends)
                out.append((None if i == NO_ID else i, len(data), len(data) - len(kept), len(begins), sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 4, pa.string()), strict=True)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    joined = rows.join(per_text_spans(rows), ["id", "th"], "left").select("id", "th", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings taken out of ``text``; a code point that is cut through goes as a whole."""
    marked = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                               "__th": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    found = per_text_spans(keyed(docs)).select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("spans").alias("__spans"))
    joined = marked.join(found, ["__id", "__th"], "left").drop("__id", "__th")
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, found in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                if found:
                    text = without(text.encode(), *united([s["begin"] for s in found], [s["end"] for s in found])).decode("utf-8", "ignore")
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return joined.select(*names, "__spans").mapInArrow(run, docs.schema)
