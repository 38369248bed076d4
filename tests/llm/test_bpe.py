"""Byte-level BPE against tiktoken, a plain merge loop, and round trips."""

from __future__ import annotations

import base64
import functools
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from cohort_features.llm import bpe, queries
from tests.conftest import SF_SMALL
from tests.llm.conftest import stored


@functools.cache
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def plain(data: bytes, ranks) -> list[int]:
    """Merge the leftmost pair of the lowest rank, again and again."""
    if data in ranks:
        return [ranks[data]]
    parts = [bytes([b]) for b in data]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.default_ranks(), bpe.default_pattern())


def random_texts(n: int, seed: int = 11) -> list[str]:
    rng = random.Random(seed)
    signs = ["a", "b", "the", "ing", "er", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", ".", "!?", "é", "漢", "字", "\U0001f600", "́", "²", " ", "\x00", "<|endoftext|>"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_ids_are_the_librarys(vocab):
    texts = [*random_texts(1500), "", "a" * 3000, "ab" * 1500, " " * 2000, "\n" * 999 + "x", "é" * 700, "x" * 65, "y" * 64]
    every = "".join(map(chr, [*range(0x3000), *range(0x1F600, 0x1F700)]))
    texts += [every[i : i + 50] for i in range(0, len(every), 50)]
    assert [x.tolist() for x in vocab.encode_many(texts)] == [library()[0].encode_ordinary(t) for t in texts]


def test_trees_are_the_plain_loop(vocab):
    rng, ranks = random.Random(2), library()[1]
    for n in (1, 2, 3, 5, 17, 64, 65, 200):
        for _ in range(20):
            data = bytes(rng.choice(b"aeinrst h\xc3\xa9") for _ in range(n))
            want = plain(data, ranks)
            if data not in ranks:
                assert vocab.merged(data) == want
                if n <= bpe.SHORT and n > 1:
                    both = vocab.merged_together([data, b"ae", data])
                    assert [list(memoryview(x).cast("I")) for x in both][::2] == [want, want]


def test_a_cache_that_is_full_changes_nothing(vocab, monkeypatch):
    texts = random_texts(300, 12)
    want = [x.tolist() for x in vocab.encode_many(texts)]
    monkeypatch.setattr(bpe, "CACHE", 20)
    monkeypatch.setattr(bpe, "HELD_CHARS", 60)
    monkeypatch.setattr(bpe, "HELD_MATCHES", 3)
    vocab.matches.clear()
    vocab.words.clear()
    assert [x.tolist() for x in vocab.encode_many(texts)] == want


def test_query_matches_the_library(spark):
    got = {r["doc_id"]: r for r in queries.op11_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library()[0].encode_ordinary(r["text"] or "")
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
        assert tuple(got[r["doc_id"]])[1:] == want


def test_edge_rows(spark, edge, empty):
    got = bpe.round_trip(edge).collect()
    texts = [r["text"] or "" for r in edge.collect()]
    assert sorted(bytes(r["data"]).decode() for r in got) == sorted(texts)
    assert sorted(r["n_tokens"] for r in got) == sorted(len(library()[0].encode_ordinary(t)) for t in texts)
    assert bpe.round_trip(empty).count() == 0
    assert [r["data"] for r in bpe.decode(spark.createDataFrame([(1, None), (None, [])], "doc_id long, ids array<int>")).collect()] == [b"", b""]
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>")).collect()


def test_a_very_long_match_takes_little_time(spark):
    long = stored(spark, [(1, "a" * 200_000 + " " * 100_000 + "-=" * 50_000, "en", "s", 0)], files=1)
    (r,) = bpe.round_trip(long).collect()
    assert bytes(r["data"]).decode() == long.first()["text"]
