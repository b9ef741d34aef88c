"""Near-duplicate documents by DartMinHash signatures and banded joins.

A document is the weighted set of its five-word shingles (weight: how often one
occurs; a document of one to four words is one shingle of all of them). Every
unit of weight of an element is a strip of the weight axis, and hashed darts
fall on (strip, rank) regions as a Poisson process that depends on the element
alone: the gap to a strip's next dart is an exponential of a hash of element,
strip and dart number. Only darts below a rank that leaves about k ln k + 2k
per document are thrown; each falls on one of k coordinates, and the earliest
per coordinate is the signature. Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity.

Bands of signature coordinates are joined on their hash. Exact copies are one
class beforehand. A bucket is not expanded into pairs:

1. every member is compared with one hub of its bucket (another for each band);
   in buckets that are still in several components, members outside the largest
   one are compared with a new hub from it, as long as that goes on joining them;
2. members of buckets that are still in several components are joined on their
   rarest shingles: of two documents with n and m shingles that are similar
   enough, at least c = t / (1 + t) * (n + m) are common, so the first
   n - c + 1 of one and m - c + 1 of the other, ordered by how many documents
   have them, share one. Pairs within a component, and within the largest
   component that has a shingle, are not formed.

Every comparison is the exact weighted Jaccard similarity of the whole texts,
so links come from exact values and no pair that shares a bucket is lost, while
a large group of near copies costs a few comparisons per member.

Defined cases: null texts and texts without a word are never near copies and
are alone even if equal; a null id takes part as an exact copy only; rows that
share an id are one node; extra columns are ignored. Words are separated by
ASCII white space and compared as they are written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize

from .components import connected_components

SHINGLE, SIMILARITY = 5, 0.8
#: 20 bands of 5 rows: a pair at the threshold shares a bucket with probability 0.9996.
BANDS, ROWS = 20, 5
#: Buckets get another hub while this share of the comparisons with the last one were links.
MORE_HUBS = 0.02
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
#: Bytes hashed at once; bounds the tables of powers.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public constants of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the byte ranges, and how many each range has.

    A running sum folds bytes in order within a word: each byte is mixed with
    its place in the word, so equal words have equal sums wherever they stand.
    """
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    inside = ~space
    bound = np.zeros(len(raw) + 1, dtype=bool)
    bound[begins] = True
    bound[ends] = True
    start = inside & (np.r_[True, space[:-1]] | bound[:-1])
    at = np.flatnonzero(start)
    word = np.cumsum(start) - 1
    place = (np.arange(len(raw)) - at[np.maximum(word, 0)] if len(at) else np.zeros(len(raw))).astype(np.uint64)
    value = mix((place << U64(8)) + raw.astype(np.uint64) + BASE)
    value[space] = 0
    sums = np.add.reduceat(value, at) if len(at) else np.zeros(0, dtype=np.uint64)
    counts = np.searchsorted(at, ends) - np.searchsorted(at, begins)
    return mix(sums), counts


def shingles(words: np.ndarray, counts: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-tagged shingle keys of all documents in a row, and each document's number of them.

    The second occurrence of a shingle in a document is an element of its own,
    so set operations on the keys are multiset operations on the shingles.
    """
    per_doc = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    doc = np.repeat(np.arange(len(counts)), per_doc)
    first = np.repeat(np.cumsum(counts) - counts, per_doc)
    at = first + np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    last = first + counts[doc]
    padded = np.concatenate([words, np.zeros(n, dtype=np.uint64)])
    key = np.zeros(len(doc), dtype=np.uint64)
    for k in range(n):
        w = np.where(at + k < last, padded[at + k], U64(0))
        key = mix(key * BASE + w + U64(k + 1))
    order = np.lexsort((key, doc))
    same = np.r_[False, (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])]
    if same.any():
        run = np.arange(len(order)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        occurrence = np.zeros(len(order), dtype=np.uint64)
        occurrence[order] = run
        key = np.where(occurrence > 0, mix(key + occurrence * BASE), key)
    return key, per_doc


def darts(key: np.ndarray, per_doc: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (document, coordinate): the identity of the earliest dart; documents without elements stay 0."""
    n = len(per_doc)
    out = np.zeros((n, k), dtype=np.uint64)
    want = k * math.log(k) + 2 * k
    doc = np.repeat(np.arange(n), per_doc)
    todo, scale = per_doc > 0, 1.0
    while todo.any():
        chosen = todo[doc]
        strip, owner = key[chosen], doc[chosen]
        limit = scale * want / per_doc[owner]
        rank, number = np.zeros(len(strip)), 0
        found_rank = np.full(n * k, np.inf)
        thrown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(strip):
            number += 1
            dart = mix(strip + U64(number * int(BASE) & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log(((dart >> U64(11)).astype(np.float64) + 0.5) / (1 << 53))
            below = rank < limit
            strip, owner, limit, rank, dart = strip[below], owner[below], limit[below], rank[below], dart[below]
            cell = owner * k + (mix(dart + BASE) % U64(k)).astype(np.int64)
            np.minimum.at(found_rank, cell, rank)
            thrown.append((cell, rank, dart))
        flat = out.reshape(-1)
        for cell, r, dart in thrown:
            first = r == found_rank[cell]
            flat[cell[first]] = dart[first]
        # a coordinate without a dart: throw on, to twice the rank
        todo = todo & np.isinf(found_rank.reshape(n, k)).any(axis=1)
        scale *= 2
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=np.uint64) * BASE
        for r in range(rows):
            key = mix(key + signature[:, b * rows + r])
        out[:, b] = key
    return out


def blocks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about ``size`` bytes of text (last column) with words' hashes and counts."""
    for batch in batches:
        text = batch.column(batch.num_columns - 1).cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
        raw = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
        i = 0
        while i < len(text):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
            part = raw[offsets[i]:offsets[j]]
            words, counts = word_hashes(part, offsets[i:j] - offsets[i], offsets[i + 1:j + 1] - offsets[i])
            yield batch.slice(i, j - i), words, counts
            i = j


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest of the text, band keys (null without words) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, counts in blocks(batches):
            bands = band_keys(darts(*shingles(words, counts))).view(np.int64)
            column = lists(bands[counts > 0].reshape(-1), np.where(counts > 0, BANDS, 0))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), column], names=["doc_id", "digest", "bands"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(F.col(text_col).cast("string"))).alias("digest"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest binary, bands array<long>")


def elements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node, keys: the occurrence-tagged shingles of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, counts in blocks(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), lists(*shingles(words, counts))], names=["node", "keys"])
    rows = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "node long, keys array<long>")


def verified(pairs: DataFrame, keys: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches the threshold."""
    a = keys.select(F.col("node").alias("a"), F.col("keys").alias("ka"))
    b = keys.select(F.col("node").alias("b"), F.col("keys").alias("kb"))
    both = F.size(F.array_intersect("ka", "kb"))
    # shuffled at every size: the keys grow with the texts
    found = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").where(both >= similarity * (F.size("ka") + F.size("kb") - both))
    return materialize(found.select("a", "b").distinct())


def rarest(keys: DataFrame, similarity: float) -> DataFrame:
    """key, node, n, place: a document's rarest shingles that some other document of ``keys`` has.

    ``place`` counts from 1 in the order of (documents that have it, key) and
    includes the document's own shingles, which come first; places beyond those
    that any similar document must reach into are left out.
    """
    each = keys.select("node", F.size("keys").alias("n"), F.explode("keys").alias("key")).distinct().repartition("key")
    shared = each.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    listed = each.join(shared.hint("merge"), "key").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("held", "key"))).alias("known"))
    own = F.col("n") - F.size("known")
    reach = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1 - own
    near = listed.withColumns({"own": own, "reach": reach.cast("int")}).where("reach > 0")
    return (near.select("node", "n", "own", F.posexplode(F.expr("slice(known, 1, reach)")).alias("at", "one"))
            .select(F.col("one.key").alias("key"), "node", "n", (F.col("own") + F.col("at") + 1).alias("place")))


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (node, component) after the components of linked nodes (a, b) have become one."""
    ends = {x: parts.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}")) for x in ("a", "b")}
    joined = connected_components(links.join(ends["a"], "a").join(ends["b"], "b").select(F.col("part_a").alias("a"), F.col("part_b").alias("b")))
    whole = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return materialize(parts.join(whole, "component", "left").select("node", F.coalesce("whole", "component").alias("component")))


def hub_pairs(members: DataFrame, parts: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b) of a new hub from each bucket's largest component and the bucket's members outside it."""
    placed = materialize(members.join(parts, "node"))
    largest = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"), F.min_by("node", F.xxhash64("node", "bucket", F.lit(number))).alias("hub")) \
        .groupBy("bucket").agg(F.max(F.struct("size", "component", "hub")).alias("top"), F.count("*").alias("parts")).where("parts > 1") \
        .select("bucket", F.col("top.component").alias("largest"), F.col("top.hub").alias("hub"))
    outside = placed.join(largest, "bucket").where("component <> largest")
    return outside.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def near_components(classes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """node, component over all near pairs, for the nodes that have one."""
    rows = classes.where("node is not null and size(bands) > 0").select("node", F.posexplode("bands").alias("band", "bucket"))
    order = F.struct(F.xxhash64("node", "band"), F.col("node"))
    hubs = rows.groupBy("bucket").agg(F.min_by("node", order).alias("hub"), F.min("node").alias("low"), F.max("node").alias("high"))
    hubs = materialize(hubs.where("low <> high").select("bucket", "hub"))
    members = materialize(rows.join(hubs, "bucket").select("bucket", "node", "hub").distinct())
    tried = materialize(members.where("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    wanted = members.select("node").distinct()
    keys = materialize(elements(docs.join(wanted.hint("merge"), docs["doc_id"] == wanted["node"], "left_semi").select("doc_id", "text")))
    links = verified(tried, keys, similarity)

    parts = materialize(connected_components(links))
    placed = members.select("bucket", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_buckets = spread.where("low <> high").select("bucket")
    still = materialize(placed.join(open_buckets, "bucket"))
    active = materialize(still.select("node", "component").distinct())
    keys = materialize(keys.join(active.select("node").hint("merge"), "node", "left_semi"))
    # further hubs while they join a good part of what is open; what they leave open is searched pair by pair
    members, found, n, number = still.select("bucket", "node"), links.limit(0), 1, 0
    while n:
        number += 1
        pairs = materialize(hub_pairs(members, active, number).join(tried, ["a", "b"], "left_anti"))
        more = verified(pairs, keys, similarity)
        n, open_pairs = more.count(), pairs.count()
        tried = tried.unionByName(pairs)
        if n:
            active = merged(active, more)
        if n < MORE_HUBS * open_pairs:
            break

    rare = materialize(rarest(keys, similarity).join(active, "node"))
    sizes = rare.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = materialize(sizes.groupBy("key").agg(
        F.max(F.struct("size", "component"))["component"].alias("largest"), F.count("*").alias("parts"))
        .where("parts > 1").select("key", "largest"))
    rare = materialize(rare.join(largest, "key"))
    rest = rare.where("component <> largest").select(
        "key", *(F.col(c).alias(f"{c}_x") for c in ("node", "component", "n", "place")))
    others = rare.select(F.col("key").alias("key_y"), *(F.col(c).alias(f"{c}_y") for c in ("node", "component", "n", "place", "largest")))
    common = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n_x") + F.col("n_y")) - 1e-9)
    possible = (F.col("component_x") != F.col("component_y")) & (F.col("place_x") <= F.col("n_x") - common + 1) \
        & (F.col("place_y") <= F.col("n_y") - common + 1) \
        & ((F.col("component_y") == F.col("largest_y")) | (F.col("node_x") < F.col("node_y")))
    pairs = rest.join(others, (F.col("key") == F.col("key_y")) & possible).select(
        F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()
    pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"))
    last = merged(active, verified(pairs, keys, similarity))
    # what was not open keeps the component of the first round, unless that component went on growing
    first = still.select("node", F.col("component").alias("first")).distinct()
    grown = last.join(first, "node").select(F.col("first").alias("component"), F.col("component").alias("whole")).distinct()
    settled = parts.join(grown, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    return settled.unionByName(last.join(parts, "node", "left_anti").select("node", "component"))


def labelled(docs: DataFrame, similarity: float) -> DataFrame:
    """doc_id, digest (null without words), class_id, component_id of every row."""
    signed = materialize(signatures(docs))
    classes = materialize(signed.where("size(bands) > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("bands").alias("bands")))
    parts = materialize(near_components(classes, docs, similarity))
    labels = materialize(classes.select("digest", "node").join(parts, "node", "left")
                         .select("digest", F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component_id")))
    out = signed.select("doc_id", F.when(F.size("bands") > 0, F.col("digest")).alias("digest")).join(labels, "digest", "left")
    return out.select("doc_id", "digest", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest id with the same text), component_id (smallest id reachable), kept.

    One row per row of ``docs``; ``kept`` is true where doc_id = component_id,
    and for texts without words or ids that have no class.
    """
    return labelled(docs, similarity).select("doc_id", "class_id", "component_id").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component; texts without words all stay."""
    kept = labelled(docs, similarity).where(F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("digest").isNotNull()) \
        .select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    marked = docs.withColumns({"__key": F.unhex(F.md5(F.col("text").cast("string"))),
                               "__words": F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))})
    stay = marked.where("__words").join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__digest")), "left_semi") \
        .dropDuplicates(["doc_id", "__key"])
    return stay.unionByName(marked.where("not __words")).select(*docs.columns)
