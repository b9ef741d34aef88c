"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm.

A document's ids end with one separator id; only documents longer than a
sequence are cut. Full pieces are sequences of their own. All other pieces are
dealt at random to islands of bounded size, and on each island a grouping
genetic algorithm packs them: an individual is a set of bins, crossover injects
well-filled bins of one parent whole into the other, drops the bins that held
a duplicate and places the displaced pieces by best fit; mutation dissolves
poor bins. Sub-populations of an island exchange their elite.

Between epochs the elite's well-filled bins leave as finished sequences, and
the pieces of its other bins migrate to new islands, where they meet pieces
from elsewhere; the last epoch finishes every bin. Tasks hold one island,
the driver holds counts, and every epoch is a table in the shared folder.

Defined cases: a null or empty text is the separator alone; repeated rows and
null ids are packed like others; an empty table gives no row; extra columns are
ignored.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenizers import Tokenizer, normalizers, pre_tokenizers

from nearcast.session import materialize

CAPACITY = 4096
SEPARATOR = 1
ISLAND, EPOCHS = 2048, 4
POPULATION, GENERATIONS, GROUPS = 4, 12, 2
#: A bin leaves as a finished sequence when at most this share of it is empty.
SLACK = 0.002
#: Encoded runs of text from which a Python worker drops those it met once, and bytes of text it encodes at once.
KEPT_RUNS, BLOCK = 400_000, 8 << 20
#: Bytes that a row of a block takes besides its text.
ROW = 256
SYMBOLS = string.punctuation
#: Words of small Latin letters: the library neither changes nor splits them.
PLAIN = "^[a-zß-öø-ÿ]+$"


def stretches(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions in stretches of an array, one stretch after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def joined(words: pa.Array, mark: str) -> str:
    """Words with a mark between them, as one text."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    return pc.binary_join(whole, pa.scalar(mark, words.type))[0].as_py()


def tails(words: pa.Array, skipped: np.ndarray) -> pa.Array:
    """What follows the first ``skipped`` bytes of every word (large strings without nulls)."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    size = np.diff(offsets) - skipped
    held = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[stretches(offsets[:-1] + skipped, size)]
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(np.r_[0, np.cumsum(size)]), pa.py_buffer(held))


class RunTable:
    """Ids of the runs of text between white space, which the library has encoded once each.

    The library drops white space and never joins tokens across it, so a text's
    ids are those of its runs. Runs are split, told apart and looked up by Arrow,
    a block of texts at a time; a run is held without the symbols behind it and in
    small letters, and no run becomes a Python string. The ids of all runs lie in
    one array. A full table keeps the runs that came more than once.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = list(self.library.get_added_tokens_decoder().items())
        self.mark, self.mark_text = self.special[0][0], self.special[0][1].content
        # plain words need neither normalising nor splitting, and each ends with a token that ends words
        self.plain = Tokenizer.from_file(path)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.library.model.end_of_word_suffix
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for label, i in vocab.items() if suffix and label.endswith(suffix)]] = True
        # texts with a special token, or a separator that the library counts as a symbol, are not looked up by runs
        odd = [*"\x1c\x1d\x1e\x1f", *(t.content for _, t in self.special)]
        self.odd = "|".join(map(re.escape, odd))
        # capital letters stay where small ones would make a special token, or might join a mark that follows
        self.as_is = r"[A-Z]\p{M}|(?i:" + "|".join(re.escape(t.content) for _, t in self.special) + ")"
        self.clear()

    def clear(self) -> None:
        """Keep the empty run alone, entry 0."""
        self.index = pa.array([""], pa.large_string())
        self.ids, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.met = np.zeros(1, dtype=bool)

    def shrink(self, most: int) -> None:
        """Keep the runs that were met again since they were added or last kept, ``most`` at most, oldest first."""
        code = 1 + np.flatnonzero(self.met[1:])[:most]
        names, ids, size = self.index.take(pa.array(code)), self.segments(code), self.size[code]
        self.clear()
        self.append(names, ids, size)

    def append(self, names: pa.Array, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Add runs with their ids; their entries."""
        code = np.arange(len(self.size), len(self.size) + len(names))
        self.index = pa.concat_arrays([self.index, names])
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.met = np.concatenate([self.met, np.zeros(len(size), dtype=bool)])
        self.ids = np.concatenate([self.ids, ids])
        return code

    def read(self, runs: pa.Array) -> np.ndarray:
        """Have the library encode runs: plain words with spaces between them, others with a special token; their entries."""
        code = np.zeros(len(runs), dtype=np.int64)
        plain = pc.match_substring_regex(runs, PLAIN).to_numpy(zero_copy_only=False)
        words = runs.filter(pa.array(plain))
        if len(words):
            ids = np.array(self.plain.encode_batch_fast([joined(words, " ")], add_special_tokens=False)[0].ids, dtype=np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(words):
                code[plain] = self.append(words, ids, np.diff(last, prepend=-1))
            else:
                plain[:] = False
        if not plain.all():
            words = runs.filter(pa.array(~plain))
            ids = np.array(self.library.encode_batch_fast([joined(words, self.mark_text)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            marks = np.flatnonzero(ids == self.mark)
            code[~plain] = self.append(words, ids[ids != self.mark], np.diff(np.r_[-1, marks, len(ids)]) - 1)
        return code

    def segments(self, code: np.ndarray) -> np.ndarray:
        """The ids of entries, one entry after the other."""
        return self.ids[stretches(self.begin[code], self.size[code])]

    def known(self, runs: pa.Array) -> np.ndarray:
        """The entries of runs, which may be equal; those not seen before are read."""
        found = pc.index_in(runs, value_set=self.index)
        missed = found.is_null().to_numpy(zero_copy_only=False)
        code = found.fill_null(0).to_numpy().astype(np.int64)
        self.met[code[~missed]] = True
        if missed.any():
            told = runs.filter(pa.array(missed)).dictionary_encode()
            code[missed] = self.read(told.dictionary)[told.indices.to_numpy()]
        return code

    def parts(self, runs: pa.Array) -> np.ndarray:
        """Two entries of every run, its ids in order: capital ASCII letters and symbols after a letter need no reading of their own."""
        stems = pc.utf8_rtrim(runs, characters=SYMBOLS)
        cut = pc.less(pc.binary_length(stems), pc.binary_length(runs))
        last = pc.utf8_slice_codeunits(stems.filter(cut), start=-1).dictionary_encode()
        letter = pa.array([c.lower().isalpha() for c in last.dictionary.to_pylist()], pa.bool_()).take(last.indices)
        cut = pc.replace_with_mask(cut, cut, letter)
        stems = pc.if_else(cut, stems, runs)
        stems = pc.if_else(pc.match_substring_regex(stems, self.as_is), stems, pc.ascii_lower(stems))
        rest = tails(runs.filter(cut), pc.binary_length(stems.filter(cut)).to_numpy())
        code = self.known(pa.concat_arrays([stems, rest]))
        out = np.zeros((len(runs), 2), dtype=np.int64)
        out[:, 0] = code[:len(runs)]
        out[cut.to_numpy(zero_copy_only=False), 1] = code[len(runs):]
        return out

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Token ids of whole texts (null: none)."""
        texts = pa.array(texts) if isinstance(texts, list) else texts
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.odd)
        runs = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        told = pc.list_flatten(runs).dictionary_encode()
        if len(self.size) > KEPT_RUNS:
            self.shrink(KEPT_RUNS // 2)
        # the ids of the block's different runs lie together, those of all its runs are taken from there
        parts = self.parts(told.dictionary)
        held, size = self.segments(parts.ravel()), self.size[parts].sum(axis=1)
        code = told.indices.to_numpy()
        ids = held[stretches((np.cumsum(size) - size)[code], size[code])]
        bounds = np.r_[0, np.cumsum(size[code])][runs.offsets.to_numpy() - runs.offsets[0].as_py()]
        out = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = np.array(self.library.encode(texts[i].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
        return out


@lru_cache(maxsize=2)
def run_table(path: str) -> RunTable:
    """One table per Python worker and file."""
    return RunTable(path)


def weights(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of text (last column) of every row, and what a row takes besides."""
    return ROW + pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batch: pa.RecordBatch, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes, one row at least."""
    held = np.cumsum(weights(batch))
    i = 0
    while i < len(held):
        j = max(i + 1, int(np.searchsorted(held, (held[i - 1] if i else 0) + size)))
        yield batch.slice(i, j - i)
        i = j


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Batches cut, and small ones joined, to about ``size`` bytes: every block looks its runs up in the whole table."""
    held, total = [], 0
    for part in (p for b in batches for p in slices(b, size)):
        more = int(weights(part).sum())
        if held and total + more > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(part)
        total += more
    if held:
        yield pa.concat_batches(held)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = run_table(path)
        for part in blocks(batches):
            rows = []
            for doc_id, ids in zip(part.column(0).to_pylist(), table.encode(part.column(1)), strict=True):
                ids = np.append(ids, np.uint32(separator)).astype("<u4")
                rows += [(doc_id, k, at, len(ids[at:at + capacity]), crc32(ids[at:at + capacity].tobytes()))
                         for k, at in enumerate(range(0, len(ids), capacity))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Packing:
    """An individual: the bin of every piece and the fill of every bin."""

    def __init__(self, size: np.ndarray, capacity: int, bin_of: np.ndarray | None = None, fill: np.ndarray | None = None):
        self.size, self.capacity = size, capacity
        self.bin_of = np.full(len(size), -1) if bin_of is None else bin_of
        self.fill = np.zeros(0, dtype=np.int64) if fill is None else fill

    def copy(self) -> Packing:
        return Packing(self.size, self.capacity, self.bin_of.copy(), self.fill.copy())

    def fitness(self) -> float:
        used = self.fill[self.fill > 0]
        return float(np.mean((used / self.capacity) ** 2)) if len(used) else 0.0

    def place(self, items: np.ndarray) -> None:
        """Best fit, in the given order: the fullest bin with room, else a new one."""
        room = sorted((int(self.capacity - f), b) for b, f in enumerate(self.fill) if 0 < f < self.capacity)
        fill = self.fill.tolist()
        for i, s in zip(items.tolist(), self.size[items].tolist(), strict=True):
            at = bisect_left(room, (s, -1))
            if at < len(room):
                left, b = room.pop(at)
            else:
                left, b = self.capacity, len(fill)
                fill.append(0)
            fill[b] += s
            self.bin_of[i] = b
            if left > s:
                insort(room, (left - s, b))
        self.fill = np.array(fill, dtype=np.int64)

    def dissolve(self, bins: np.ndarray) -> np.ndarray:
        """Empty some bins; the pieces they held."""
        gone = np.zeros(len(self.fill) + 1, dtype=bool)
        gone[bins] = True
        items = np.flatnonzero(gone[self.bin_of] & (self.bin_of >= 0))
        self.fill[bins] = 0
        self.bin_of[items] = -1
        return items

    def tidy(self) -> None:
        """Number the bins in use from 0."""
        used, self.bin_of = np.unique(self.bin_of, return_inverse=True)
        self.fill = self.fill[used]


def larger_first(size: np.ndarray, items: np.ndarray) -> np.ndarray:
    return items[np.argsort(-size[items], kind="stable")]


def crossover(a: Packing, b: Packing, rng: np.random.Generator) -> Packing:
    """Inject well-filled bins of ``b`` into ``a``, drop what they duplicate, best-fit what that displaces."""
    good = np.flatnonzero(b.fill >= np.quantile(b.fill, 0.5))
    taken = rng.choice(good, max(1, len(good) // 2), replace=False)
    child = a.copy()
    chosen = np.zeros(len(b.fill), dtype=bool)
    chosen[taken] = True
    injected = np.flatnonzero(chosen[b.bin_of])
    displaced = child.dissolve(np.unique(child.bin_of[injected]))
    number = np.cumsum(chosen) - 1 + len(child.fill)
    child.bin_of[injected] = number[b.bin_of[injected]]
    child.fill = np.concatenate([child.fill, b.fill[chosen]])
    child.place(larger_first(a.size, displaced[child.bin_of[displaced] < 0]))
    child.tidy()
    return child


def mutate(p: Packing, rng: np.random.Generator) -> None:
    """Dissolve some of the emptier bins and place their pieces anew."""
    worst = np.argsort(p.fill, kind="stable")[:max(2, len(p.fill) // 10)]
    items = p.dissolve(rng.choice(worst, min(len(worst), max(2, len(worst) // 2)), replace=False))
    p.place(larger_first(p.size, items))
    p.tidy()


def evolve(size: np.ndarray, capacity: int, seed: int, generations: int = GENERATIONS) -> np.ndarray:
    """The bin of each piece in the best individual of one island.

    One individual starts with best fit decreasing, the others with pieces in
    random order. The search ends with the first child that needs no more bins
    than the pieces' total does, or after all generations.
    """
    rng = np.random.default_rng(seed)
    bound = -(-int(size.sum()) // capacity)
    groups: list[list[Packing]] = []
    for g in range(GROUPS):
        groups.append([])
        for k in range(POPULATION):
            p = Packing(size, capacity)
            p.place(larger_first(size, np.arange(len(size))) if g == k == 0 else rng.permutation(len(size)))
            groups[-1].append(p)
    for _ in range(generations):
        for group in groups:
            group.sort(key=Packing.fitness, reverse=True)
            mate = group[1 + int(rng.integers(len(group) - 1))]
            for child in (crossover(group[0], mate, rng), crossover(mate, group[0], rng)):
                mutate(child, rng)
                if len(child.fill) <= bound:
                    return child.bin_of
                weakest = min(range(len(group)), key=lambda i: group[i].fitness())
                if child.fitness() > group[weakest].fitness():
                    group[weakest] = child
        elite = [max(g, key=Packing.fitness) for g in groups]
        for i, g in enumerate(groups):  # the neighbour's elite replaces the weakest
            weakest = min(range(len(g)), key=lambda j: g[j].fitness())
            g[weakest] = elite[i - 1].copy()
    return min((p for g in groups for p in g), key=lambda p: (len(p.fill), -p.fitness())).bin_of


def on_island(epoch: int, last: bool, capacity: int):
    """The task of one island: evolve, lay out the bins, mark those that are finished."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        size, here = pdf["length"].to_numpy(), int(pdf["island"].iat[0])
        bin_of = evolve(size, capacity, seed=epoch * 1_000_003 + here)
        fill = np.bincount(bin_of, weights=size)
        finished = (fill >= capacity * (1 - SLACK))[bin_of] | last
        order = np.lexsort((pdf["uid"].to_numpy(), bin_of))
        ends = np.cumsum(size[order])
        begins = ends - size[order]
        first = np.r_[True, bin_of[order][1:] != bin_of[order][:-1]]
        offset = np.empty(len(size), dtype=np.int64)
        offset[order] = begins - np.maximum.accumulate(np.where(first, begins, 0))
        pdf["sequence_id"] = (epoch << 56) + (here << 24) + bin_of
        pdf["offset"] = offset
        pdf["finished"] = finished
        return pdf.drop(columns="island")
    return run


def pack(rows: DataFrame, capacity: int = CAPACITY, island: int = ISLAND, epochs: int = EPOCHS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length``.

    Sequence numbers: the highest byte is the epoch (0 for full pieces), then
    the island and the bin, so no counter is shared between tasks.
    """
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()))
    done = [rows.where(F.col("length") == capacity).withColumn("sequence_id", F.col("uid")).withColumn("offset", F.lit(0).cast("long"))]
    left = rows.where(F.col("length") < capacity)
    schema = left.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")
    for epoch in range(1, epochs + 1):
        n = left.count()
        if not n:
            break
        islands = -(-n // island)
        last = epoch == epochs or islands == 1

        # xxhash64 of the row number: rows that look alike are dealt apart
        dealt = left.withColumn("island", F.pmod(F.xxhash64("uid", F.lit(epoch)), F.lit(islands)))
        packed = materialize(dealt.groupBy("island").applyInPandas(
            on_island(epoch, last, capacity), f"{schema}, sequence_id long, offset long, finished boolean"))
        done.append(packed.where("finished").drop("finished"))
        left = packed.where("not finished").select(*left.columns)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("uid")
