"""BPE encoding by a tokenization automaton, decoding by its arc labels.

The automaton reads tokens. It starts with one state over the base symbols and
takes the merges one after the other, each as a gadget: merge (u, v) adds the
arc label uv, entered wherever u could be entered and left like v at that
moment, and takes the arc v away from the state after u. The result is
deterministic and accepts exactly the token sequences that the merges produce.
A state stands for "the last token was t"; since a gadget copies from what
exists when it is applied, an arc (s, t) is decided by following the newer of
s and t back to the part it was copied from. ``Automaton.arc`` does that once
and keeps the answer as a table entry.

A pre-split word is read from left to right: every prefix has one accepted
path, whose last token is the longest one that ends there and has an arc from
the last token of what precedes it. Words that were read before are looked up.

Defined cases: a null or empty text has no token; white space separates words
and is dropped; the file's two special tokens are recognised in a text as the
library does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain
from unicodedata import category, is_normalized, normalize

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

# fixed values: the tokenizer file's pre-split pattern, with Unicode white space spelled out
SPACE = "\x09-\x0d\x20\x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
SEPARATORS = regex.compile("[\x1c-\x1f]")
END = "\U0010ffff"
#: Entries of the word tables of one Python worker (two generations each) and of its arc table.
KEPT_WORDS = 250_000
KEPT_ARCS = 2_000_000


def byte_alphabet() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Automaton:
    """Compiled from a vocabulary (label to id) and merges in order of rank."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str = "</w>"):
        self.vocab = vocab
        self.labels: list[str | None] = [None] * (max(vocab.values()) + 1)
        for label, i in vocab.items():
            self.labels[i] = label
        #: Every prefix of a label, the end mark being one symbol, with its token or -1.
        self.prefixes: dict[str, int] = {}
        self.size = [0] * len(self.labels)
        for label, i in vocab.items():
            text = label.removesuffix(end) + END * label.endswith(end)
            self.size[i] = len(text)
            for k in range(1, len(text)):
                self.prefixes.setdefault(text[:k], -1)
            self.prefixes[text] = i
        n = len(self.labels)
        self.entered_like, self.left_like = [-1] * n, [-1] * n
        self.born = [-1] * n
        self.cut: dict[int, int] = {}
        for time, (u, v) in enumerate(merges):
            self.gadget(time, vocab[u], vocab[v], vocab[u + v])
        self.arcs: dict[int, bool] = {}

    def gadget(self, time: int, u: int, v: int, uv: int) -> None:
        self.entered_like[uv], self.left_like[uv], self.born[uv] = u, v, time
        self.cut[u << 32 | v] = time

    def arc(self, s: int, t: int) -> bool:
        """Whether token ``t`` may follow token ``s``."""
        key = s << 32 | t
        if (known := self.arcs.get(key)) is not None:
            return known
        now = len(self.cut)
        while True:
            if self.cut.get(s << 32 | t, now) < now:
                found = False
                break
            if self.born[s] < 0 and self.born[t] < 0:
                found = True
                break
            if self.born[s] > self.born[t]:
                now, s = self.born[s], self.left_like[s]
            else:
                # a label uu is not entered from u: the left pair of uuu merges first
                now, t = self.born[t] + 1, self.entered_like[t]
        if len(self.arcs) >= KEPT_ARCS:
            self.arcs.clear()
        self.arcs[key] = found
        return found

    def matches(self, text: str, at: int) -> list[int]:
        """Tokens that the text goes on with, shortest first."""
        out, end, prefixes = [], at + 1, self.prefixes
        while (t := prefixes.get(text[at:end])) is not None:
            if t >= 0:
                out.append(t)
            if end == len(text):
                break
            end += 1
        return out

    def read(self, word: str) -> list[int]:
        """Token ids of a word given in the byte alphabet.

        Longest arc first. A prefix has one accepted path, so a position whose
        arcs all fail is dead for good and the reading goes back one arc.
        """
        text = word + END
        n, size, arc = len(text), self.size, self.arc
        path, at, options, dead = [], [0], [self.matches(text, 0)], set()
        while (here := at[-1]) < n:
            left = options[-1]
            while left:
                t = left.pop()
                end = here + size[t]
                if end not in dead and (not path or arc(path[-1], t)):
                    path.append(t)
                    at.append(end)
                    options.append(self.matches(text, end) if end < n else [])
                    break
            else:
                if not path:
                    raise ValueError(f"no path through the automaton: {word!r}")
                dead.add(at.pop())
                options.pop()
                path.pop()
        return path


class Encoder:
    """Normalise, pre-split, run words through the automaton; ``ids`` and ``decode``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = [*self.automaton.labels]
        for label, i in self.special.items():
            self.labels += [None] * (i + 1 - len(self.labels))
            self.labels[i] = label
        self.numbers = [str(i) for i in range(len(self.labels))]
        alphabet = byte_alphabet()
        self.symbols = {chr(b): s for b, s in alphabet.items()}
        self.table = str.maketrans(self.symbols)
        self.split = regex.compile(PATTERN).findall
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.path = path
        self.assigned: set[str] = set()
        self.known: dict[str, list[int]] = {}
        self.before: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        """Ids of a run of text without white space, from the older table or the automaton."""
        if (ids := self.before.get(w)) is None:
            ids = []
            for x in self.split(w):
                ids += self.automaton.read(x.encode("utf-8").decode("latin-1").translate(self.table))
        if len(self.known) >= KEPT_WORDS:
            self.before, self.known = self.known, {}
        self.known[w] = ids
        return ids

    def unassigned(self, text: str) -> bool:
        """Whether a code point is unknown to this Python's Unicode tables; the library's may differ there."""
        if new := set(text) - self.assigned:
            self.assigned |= {c for c in new if category(c) != "Cn"}
            return not new <= self.assigned
        return False

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def ids(self, text: str | None) -> list[int]:
        """Token ids of a whole text."""
        if not text:
            return []
        if any(s in text for s in self.special):
            parts = ([self.special[p]] if p in self.special else self.ids(p) for p in self.at_special(text))
            return list(chain.from_iterable(parts))
        if not text.isascii() and self.unassigned(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return list(chain.from_iterable(self.automaton.read(w) for w, _ in pieces))
        if not is_normalized("NFC", text):
            text = normalize("NFC", text)
        # lower case by code point: Python alone would look at the neighbours of a capital sigma
        text = text.replace("Σ", "σ").lower()
        # str.split also splits at the four separators that the pattern counts as symbols
        runs = self.split(text) if SEPARATORS.search(text) else text.split()
        known = self.known.get
        return list(chain.from_iterable([known(w) or self.word(w) for w in runs]))

    def decode(self, ids: list[int]) -> str:
        """Arc labels, one space between tokens (the file names no decoder)."""
        return " ".join(map(self.labels.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One compiled automaton per Python worker and file."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and the decoded text of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            ids = [e.ids(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array([e.decode(x) for x in ids], pa.string())],
                                             names=["doc_id", "ids", "decoded"])
    rows = docs.selectExpr(f"cast({id_col} as long) as doc_id", f"cast({text_col} as string) as text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and the SHA-256 of ids and decoded text of every row, computed where it is encoded."""
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        number = e.numbers.__getitem__
        for batch in batches:
            counts, by_id, by_text = [], [], []
            for t in batch.column(1):
                ids = e.ids(t.as_py())
                counts.append(len(ids))
                by_id.append(sha256(" ".join(map(number, ids)).encode()).hexdigest())
                by_text.append(sha256(e.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(by_id), pa.array(by_text)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
