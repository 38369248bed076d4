"""Packing by concatenation and cut.

All documents, in the order of their stored files, form one stream of token
ids, each document ended by an id of its own; the stream is cut every 2048
ids. Two passes over partitions: the first tokenizes, stores ids with the
count of ids before them in their partition, and yields one total per
partition; prefix sums over those totals (one number per partition on the
driver, as many as Spark itself tracks) give every partition's global offset.
The second pass cuts each document at the fixed windows and emits its pieces;
a document over a border appears in both windows. No sort, no shuffle. Only
the very last sequence holds padding.

The ids are those of the ``tokenizers`` file ``byte_bpe_50k.json``. They are
computed from the same vocabulary's rank file with ``tiktoken`` and a bounded
cache of words, about ten times as fast; the tests compare both.

Defined results: null text counts as empty and gives one piece with the end
id; a document of any length is tokenized whole; repeated rows are packed
each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.common import python_env, store

LENGTH = 2048
END_ID = 1
SPECIAL = {"<|endoftext|>": 50256}  # fixed value of the vocabulary
CACHE_WORDS = 150_000


def _default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Whole texts to ids, as bytes of little-endian uint32.

    The pattern that splits text before merging never spans a space that
    stands before another character, so text is split there and words are
    looked up; texts with runs of spaces go to the tokenizer whole."""

    def __init__(self, ranks_path: str):
        python_env()
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        self.cache: dict[str, bytes] = {}
        (self.nul,) = self.bpe.encode_ordinary("\0")

    def whole(self, text: str) -> bytes:
        return np.array(self.bpe.encode(text, allowed_special="all"), dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of " " + word for many new words in one call, with a NUL (no
        merge holds it) between them."""
        plain = [w for w in words if w and not (w[-1].isspace() or "\0" in w)]
        if plain:
            ids = np.array(self.bpe.encode_ordinary("\0 ".join(["", *plain])), dtype="<u4")
            ends = np.flatnonzero(ids == self.nul)
            at = ids.tobytes()
            for w, a, b in zip(plain, ends.tolist(), [*ends[1:].tolist(), len(ids)], strict=True):
                self.cache[w] = at[4 * a + 4 : 4 * b]
        for w in words:
            if w not in self.cache:
                self.cache[w] = self.whole(" " + w)

    def __call__(self, text: str) -> bytes:
        if "  " in text or "<|" in text:
            return self.whole(text)
        first, *words = text.split(" ")
        cache = self.cache
        new = set(words).difference(cache)
        if new:
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                new = set(words)
            self._learn(list(new))
        return self.whole(first) + b"".join(map(cache.__getitem__, words))


@functools.cache
def encoder(ranks_path: str) -> Encoder:
    return Encoder(ranks_path)


def token_ids(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, text) to (part, before, doc_id, ids): ids as little-endian
    uint16 (the vocabulary has 50,257) without the end id; ``before`` counts
    the ids of earlier documents in this partition, end ids included."""
    path = ranks_path or _default_ranks()

    def run(rows):
        encode, before = encoder(path), 0
        for part, doc_id, text in rows:
            ids = np.frombuffer(encode(text or ""), "<u4")
            yield part, before, doc_id, ids.astype("<u2").tobytes()
            before += len(ids) + 1
        encoder(path).cache.clear()  # workers live on

    return map_rows(docs.select(F.spark_partition_id().alias("part"), "doc_id", "text"), run, "part int, before long, doc_id long, ids binary")


def pack(docs: DataFrame, length: int = LENGTH, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids (little-endian uint16)."""
    stored = store(token_ids(docs, ranks_path), "ids")
    totals = stored.groupBy("part").agg(F.max(F.col("before") + F.length("ids") / 2 + 1).cast("long").alias("n")).orderBy("part").collect()
    base, at = {}, 0
    for r in totals:
        base[r["part"]] = at
        at += r["n"]

    def run(rows):
        for part, before, doc_id, ids in rows:
            ids = np.append(np.frombuffer(ids, "<u2"), np.uint16(END_ID))
            at, start, n = base[part] + before, 0, len(ids)
            while start < n:
                offset = (at + start) % length
                size = min(length - offset, n - start)
                piece = ids[start : start + size]
                yield doc_id, start, size, zlib.crc32(piece.astype("<u4").tobytes()), n, (at + start) // length, offset, piece.tobytes()
                start += size

    return map_rows(
        stored.select("part", "before", "doc_id", "ids"),
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
