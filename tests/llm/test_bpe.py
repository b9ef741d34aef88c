import random
from hashlib import sha256

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nearcast.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n\t", "Hello, World's best!! don't they'll 123", "naïve café ŒUVRE straße İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ",
         "é ẛ̣ ﬁ Ⅷ ½ ٣ 中文字符 日本語 한국어 😀👍🏽 a‍b c　d\x1ce\x85f",
         "<|startoftext|>Hi<|endoftext|> <|endoftext|", "x" * 5000, "aAaA" * 3000 + " zz", "''s's'S'LL re've",
         "\x00\x01   ﻿ �", "###&&&%%%$$$***", "antidisestablishmentarianism" * 40]


@pytest.fixture(scope="module")
def pair():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t, bpe.encoder(PATH)


def same(pair, text):
    lib, own = pair
    want = lib.encode(text, add_special_tokens=False).ids
    got = own.ids(text)
    assert got == want, repr(text[:200])
    assert own.decode(got) == lib.decode(want, skip_special_tokens=False)


def test_texts(pair):
    for t in TEXTS:
        same(pair, t or "")


def test_random_texts(pair):
    rng = random.Random(3)
    pools = ["abcdefghinorst", "etaoin shrdlu\n", "".join(map(chr, range(32, 1000))), "éèêçàüöäßñóí.,;'!$%&*#|",
             "".join(map(chr, range(0x370, 0x1100))), "".join(map(chr, range(0x1e00, 0x2100))) + "😀👩‍👩‍👧́"]
    for i in range(3000):
        same(pair, "".join(rng.choices(pools[i % len(pools)], k=rng.randrange(1, 60))))


def test_random_vocabulary_pieces(pair):
    labels = [x.replace("</w>", "") for x in pair[1].automaton.vocab if x.isascii()]
    rng = random.Random(4)
    for _ in range(3000):
        same(pair, "".join(rng.choices(labels, k=rng.randrange(1, 8))))


def test_queries(spark, pair):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)] + [(None, "x", "y")], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.digests(df, PATH).collect()}
    whole = {r.doc_id: r for r in bpe.encode(df, PATH).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        ids = pair[0].encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == sha256(pair[0].decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert whole[i].ids == ids
    assert bpe.digests(df.limit(0), PATH).count() == 0
