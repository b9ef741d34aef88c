import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
from zlib import crc32

from nearcast.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_individual_operators_keep_pieces():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 100, 300)
    a, b = packing.Packing(size, 100), packing.Packing(size, 100)
    a.place(np.arange(300))
    b.place(rng.permutation(300))
    for _ in range(20):
        c = packing.crossover(a, b, rng)
        packing.mutate(c, rng)
        assert np.array_equal(np.bincount(c.bin_of, weights=size).astype(int), c.fill) and c.fill.max() <= 100
        a, b = b, c


@pytest.mark.parametrize("n", [1, 2, 700])
def test_near_the_lower_bound(n):
    size = np.random.default_rng(n).integers(1, 3000, n)
    bins = packing.evolve(size, 4096, 1).max() + 1
    assert bins <= 1 + 1.01 * size.sum() / 4096


def test_evolution_beats_best_fit_decreasing():
    # thirds: best fit decreasing needs extra bins for triples that fill a bin exactly
    rng = np.random.default_rng(7)
    a = rng.integers(380, 491, 60)
    b = rng.integers(250, (1000 - a) // 2 + 1)
    size = np.concatenate([a, b, 1000 - a - b])
    plain = packing.Packing(size, 1000)
    plain.place(packing.larger_first(size, np.arange(180)))
    assert packing.evolve(size, 1000, 3, generations=60).max() + 1 < len(plain.fill)


def test_ids_are_those_of_the_library(spark):
    lib = Tokenizer.from_file(PATH)
    rng = np.random.default_rng(9)
    texts = ["", " ", "a\x1cb c", "x<|endoftext|>y z", "Don't STOP  me\u00a0now\u3000é e\u0301", "İΣΑΣ ΣΣ", "\u0558 \U00010940x"]
    texts += ["it's. we'll!! he'd'", "a$$$ b%%% 's 't. x'S! É### 9## ## #a# a#a# don't's''", "_a_ a_ a' 'a'"]
    texts += ["".join(rng.choice(list("abcdst'#.$ É1"), int(rng.integers(0, 40)))) for _ in range(2000)]
    texts += ["".join(rng.choice(list("abcZ ',.é\n#1中"), int(rng.integers(0, 80)))) for _ in range(500)]
    table = packing.RunTable(PATH)
    for _ in range(2):
        for t, ids in zip(texts, table.encode(texts), strict=True):
            assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
    assert table.encode([]) == []


def test_documents(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta's"], rng.integers(0, 600))), "x") for i in range(400)]
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "null id", "x"), (1002, "word " * 20_000, "x")] + [(7, "same", "x")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    got = packing.pack(packing.pieces(df, PATH), island=64, epochs=3).collect()
    total = sum(r.length for r in got)
    assert check(got, 4096) <= 1.05 * total / 4096 + 1
    lib = Tokenizer.from_file(PATH)
    seen = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got}
    want, n = set(), 0
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want.add((i, k, at, len(part), crc32(np.array(part, "<u4").tobytes())))
            n += 1
    assert seen == want and len(got) == n


def test_empty_and_unpackable(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(df, PATH)).count() == 0
    big = spark.createDataFrame([(i, 3000) for i in range(300)], "doc_id long, length long")
    got = packing.pack(big, island=32).collect()
    assert len(got) == 300 and check(got, 4096) == 300


def test_packings_come_from_crossovers(spark, monkeypatch):
    """Bins of an island are those of a child, and no more than best fit decreasing needs."""
    children = []
    cross = packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda a, b, rng: children.append(cross(a, b, rng)) or children[-1])
    size = np.random.default_rng(11).integers(1, 4096, 1500)
    plain = packing.Packing(size, 4096)
    plain.place(packing.larger_first(size, np.arange(1500)))
    bin_of = packing.evolve(size, 4096, 5)
    assert children and bin_of.max() + 1 <= len(plain.fill)
    assert np.bincount(bin_of, weights=size).max() <= 4096


def test_plain_words_and_others_are_read_alike():
    lib = Tokenizer.from_file(PATH)
    table = packing.RunTable(PATH)
    texts = [None, "straße ÀB àb ªx ºx dtİ' İ. ẖ H̱ ẖ ﬁn", "word " * 5 + "$$$ ..", "plain words alone"]
    for t, ids in zip(texts, table.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_a_full_table_keeps_the_runs_that_came_again(monkeypatch):
    """Runs are read by the library once, however many others come and go; ids stay those of the library."""
    monkeypatch.setattr(packing, "KEPT_RUNS", 300)
    table, lib, read = packing.RunTable(PATH), Tokenizer.from_file(PATH), []
    plain = packing.RunTable.read

    def counted(self, runs):
        read.extend(runs if isinstance(runs, list) else runs.to_pylist())
        return plain(self, runs)
    monkeypatch.setattr(packing.RunTable, "read", counted)
    common = ["often", "Common.", "É###", "straße", "x1$", "été"]
    rng = np.random.default_rng(4)
    letters = list("abcdeéßÉZ'.#$1中\u0301")
    for i in range(12):
        texts = [" ".join(["".join(rng.choice(letters, int(rng.integers(1, 9)))) for _ in range(20)] + common) for _ in range(10)]
        for t, ids in zip(texts, table.encode(texts), strict=True):
            assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
        assert len(table.index) <= len(table.size) <= 300 + 3 * 200 + 30
    assert [read.count(w) for w in ("often", "straße", "x1$", "été")] == [1, 1, 1, 1]


def test_capitals_and_symbols_add_no_entries():
    """A word in capitals or with symbols behind it is made of entries that the table has."""
    lib, table = Tokenizer.from_file(PATH), packing.RunTable(PATH)
    texts = ["word Word WORD été", "word, Word. WORD,. (Word) été, word", "WORD,.", None]
    for t, ids in zip(texts, table.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(t or "", add_special_tokens=False).ids, repr(t)
    assert sorted(table.index.to_pylist()) == ["", "(word", ")", ",", ",.", ".", "word", "été"]
    assert len(table.size) == 8


def test_capitals_that_small_letters_cannot_stand_for():
    """Special tokens are told by their case; a small letter may join a mark that the capital does not."""
    lib, table = Tokenizer.from_file(PATH), packing.RunTable(PATH)
    texts = ["<|ENDOFTEXT|>x y", "a<|EndOfText|>É", "<|endoftext|>", "H̱a ẖa J̌X. T̈, W̊ Y̊", "ÉTÉ À,"]
    for t, ids in zip(texts, table.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_blocks_join_small_batches_and_cut_large_ones():
    texts = [None, "", "a" * 50, "b" * 5000, "c"] * 20
    rows = pa.record_batch([pa.array(range(100)), pa.array(texts)], names=["doc_id", "text"])
    got = list(packing.blocks((rows.slice(i, 3) for i in range(0, 100, 3)), 4000))
    assert pa.Table.from_batches(got).combine_chunks().to_batches() == [rows]
    assert len(got) == 41 and all(b.num_rows == 1 or packing.weights(b).sum() <= 4000 for b in got)
    assert list(packing.blocks(iter([]))) == []
