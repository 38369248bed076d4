"""Hard negatives of anchors among labelled vectors, by Kronecker products.

A component x becomes the integer floor(256 x), a row's score is its integer
inner product with the anchor. Kronecker packing: of the candidates' components
in one dimension, several go into separated fields of one wide integer. All
components are biased by the smallest there is, so that fields hold numbers
from 0 and, being wide enough for the largest possible sum, never carry into
each other. One multiplication per anchor component (and one addition) then
advances the scores of all candidates of a word at once; shifts, masks and the
sums of the components take the exact scores out again. The word is a 64-bit
integer (two candidates of 64 dimensions of unit vectors), or, where one field
would not fit, a Python integer of WIDE candidates.

Two passes over a grid of cells (block of anchors x part of the rows). Blocks
are bounded in bytes, parts in rows; each cell is one task that holds its block
and streams its part, keeping the best few for each anchor. The first pass
finds each anchor's positives, the best rows of its own label; the second, with
their scores known, the best rows of other labels whose score lies between
``least`` percent of the positive's and the positive's own. What the cells
found is merged by a window over a few rows per cell. No pair of rows is ever a
row of a table, but for those found.

Defined results: rows with a null label or vector, or a null, NaN or infinite
component, take no part; higher scores first, ties by smaller id, null ids
last, equal ids by row number; repeated rows are candidates (and anchors) of
their own; a null ``anchor`` is none; a shorter vector counts as filled with zeros; a
component over 2^1016, which 256 times makes infinite, counts as infinite; a score beyond a long is compared exactly and returned as null; an
anchor without positives, or a positive without negatives, gives no rows; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from cohort_features.llm.common import drop, numbered, store

SCALE, FEW, LEAST = 256.0, 5, 80
BITS, WIDE = 60, 32  # bits of a word that fields may take; candidates of a wider word
BLOCK_BYTES, PART_ROWS = 8 << 20, 1 << 18
CHUNK, TILE = 4096, 64  # candidates and anchors multiplied at once
NARROW = range(-(1 << 63), 1 << 63)  # scores that a long holds


class Kronecker:
    """Packed inner products of vectors whose components are low..high."""

    def __init__(self, low: int, high: int, dims: int):
        self.low, self.dims = low, dims
        self.bits = max(1, (dims * (high - low) ** 2).bit_length())
        self.wide = self.bits > BITS
        self.fields = WIDE if self.wide else BITS // self.bits
        self.word = object if self.wide else np.uint64
        self.number = object if self.wide else np.int64
        self.offset = 1 << (self.bits + 1)  # over every score's size
        self.digits = len(str(2 * self.offset))

    def integers(self, x: np.ndarray) -> np.ndarray:
        """floor(256 x), exactly."""
        whole = np.floor(SCALE * x.astype(np.float64))
        if not self.wide:
            return whole.astype(np.int64)
        return np.array([int(v) for v in whole.ravel().tolist()], dtype=object).reshape(whole.shape)

    def pack(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words (dims x words) of candidates (n x dims) and component sums;
        field f of word w is candidate f * words + w."""
        n, words = len(c), -(-len(c) // self.fields)
        out = np.zeros((self.dims, words), dtype=self.word)
        biased = (c - self.low).astype(self.word).T
        for f in range(self.fields):
            part = biased[:, f * words : (f + 1) * words]
            out[:, : part.shape[1]] += part << self._shift(f)
        return out, c.sum(axis=1) if n else np.zeros(0, dtype=self.number)

    def _shift(self, f: int):
        return f * self.bits if self.wide else np.uint64(f * self.bits)

    def ordered(self, score) -> str:
        """Text that sorts as the score does, whatever its size."""
        return str(int(score) + self.offset).zfill(self.digits)

    def score_of(self, text: str) -> int:
        return int(text) - self.offset

    def scores(self, anchors: np.ndarray, packed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Exact inner products (anchors x candidates)."""
        words, sums = packed
        biased = (anchors - self.low).astype(self.word)
        total = np.zeros((len(anchors), words.shape[1]), dtype=self.word)
        product = np.empty_like(total)
        for d in range(self.dims):
            np.multiply(biased[:, d, None], words[d], out=product)
            total += product
        mask = (1 << self.bits) - 1
        mask = mask if self.wide else np.uint64(mask)
        raw = np.concatenate([(total >> self._shift(f)) & mask for f in range(self.fields)], axis=1)[:, : len(sums)]
        # sum (a - low)(c - low) = sum a c - low (sum a + sum c) + dims low^2
        return raw.astype(self.number) + self.low * (anchors.sum(axis=1)[:, None] + sums[None, :]) - self.dims * self.low**2


class Best:
    """The best few candidates of each of ``n`` seekers, fed in tie order."""

    def __init__(self, n: int, number, floor: np.ndarray):
        self.score = np.empty((n, FEW), dtype=number)
        self.score[:] = floor[:, None]  # a candidate has to be over its seeker's floor
        self.at = np.full((n, FEW), -1, dtype=np.int64)

    def feed(self, seekers: slice, score: np.ndarray, ok: np.ndarray, first: int) -> None:
        """Scores (seekers x candidates) of candidates first, first + 1, ..."""
        row, col = np.nonzero(ok & (score > self.score[seekers, -1][:, None]).astype(bool))
        if not len(row):
            return
        some = np.unique(row)
        place = np.arange(seekers.start, seekers.stop)[some]
        at = np.searchsorted(some, row)
        rows = np.r_[np.repeat(np.arange(len(some)), FEW), at]
        values = np.concatenate([self.score[place].ravel(), score[row, col]])
        which = np.r_[self.at[place].ravel(), first + col]
        # held ones came earlier; a floor (-1) goes last
        late = np.where(which < 0, np.iinfo(np.int64).max, which)
        if values.dtype == object:
            order = np.array(sorted(range(len(rows)), key=lambda k: (rows[k], -values[k], late[k])))
        else:
            order = np.lexsort((late, -values, rows))
        starts = np.searchsorted(rows[order], np.arange(len(some)))
        take = order[(starts[:, None] + np.arange(FEW)).ravel()]
        self.score[place] = values[take].reshape(-1, FEW)
        self.at[place] = which[take].reshape(-1, FEW)


def _vectors(column: pa.ListArray, dims: int) -> np.ndarray:
    """A list column as floats (rows x dims), shorter ones filled with 0."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.offsets)
    sizes = np.diff(ends)
    if (sizes == dims).all():
        return flat.reshape(-1, dims).astype(np.float64)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def _cells(anchors: DataFrame, rows: DataFrame, blocks: int, parts: int, layout: Kronecker, seek: Callable, schema: str) -> DataFrame:
    """``seek`` over each cell. ``anchors``: rid, vec, label, wants (array of
    string); ``rows``: rid, id, vec, label."""

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    no_id = F.col("id").isNull().cast("int").alias("late")
    a = anchors.select(dealt(blocks).alias("block"), each(parts).alias("part"), F.lit(0).alias("role"), F.lit(0).alias("late"), F.lit(0).cast("long").alias("id"), "rid", "label", "wants", "vec")
    c = rows.select(each(blocks).alias("block"), dealt(parts).alias("part"), F.lit(1).alias("role"), no_id, "id", "rid", "label", F.array().cast("array<string>").alias("wants"), "vec")
    cell = F.col("block") * parts + F.col("part")
    dealt_out = a.unionByName(c).withColumn("cell", cell).repartitionById(blocks * parts, F.col("cell"))
    dealt_out = dealt_out.sortWithinPartitions("cell", "role", "late", "id", "rid").select("cell", "role", "id", "late", "rid", "label", "wants", "vec")
    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        search, at = None, None
        for batch in batches:
            cells, role = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(cells) | np.diff(role)) + 1
            for i, j in zip([0, *edges], [*edges, len(cells)], strict=True):
                if i == j:
                    continue
                if cells[i] != at:
                    if search:
                        yield from search.found(out)
                    search, at = seek(layout), cells[i]
                search.take(batch.slice(i, j - i), int(role[i]))
        if search:
            yield from search.found(out)

    return dealt_out.mapInArrow(run, schema)


class Search:
    """One cell: its anchors first, then its rows in tie order."""

    def __init__(self, layout: Kronecker):
        self.layout, self.anchors, self.rows, self.n = layout, [], [], 0
        self.ids: list[np.ndarray] = []  # of the rows that were found
        self.seen = 0
        self.best: list[Best] = []
        self.ready = False

    def take(self, batch: pa.RecordBatch, role: int) -> None:
        if role == 0:
            self.anchors.append(batch)
            return
        self.rows.append(batch)
        self.n += batch.num_rows
        if self.n >= CHUNK:
            self.compare()

    def prepare(self) -> None:
        self.ready = True
        held = self.anchors
        rid = [b.column(4).to_numpy() for b in held]
        self.rid = np.concatenate([np.zeros(0, np.int64), *rid])
        self.label = np.concatenate([np.zeros(0, np.int64), *[b.column(5).to_numpy() for b in held]])
        empty = np.zeros((0, self.layout.dims))
        self.vec = self.layout.integers(np.concatenate([empty, *[_vectors(b.column(7), self.layout.dims) for b in held]]))
        self.wants = [x for b in held for x in b.column(6).to_pylist()]
        self.anchors = []
        self.start()

    def compare(self) -> None:
        if not self.ready:
            self.prepare()
        for batch in self.rows if len(self.rid) else []:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                packed = self.layout.pack(self.layout.integers(_vectors(part.column(7), self.layout.dims)))
                rid, label = part.column(4).to_numpy(), part.column(5).to_numpy()
                for t in range(0, len(self.rid), TILE):
                    tile = slice(t, min(t + TILE, len(self.rid)))
                    self.feed(tile, self.layout.scores(self.vec[tile], packed), rid, label)
                self.keep_ids(part.column(2), rid)
                self.seen += part.num_rows
        self.rows, self.n = [], 0

    def keep_ids(self, ids: pa.Array, rid: np.ndarray) -> None:
        """Ids of the rows of this chunk that are held now; ids of rows that
        are no longer held go when there are many."""
        held = np.unique(np.concatenate([b.at.ravel() for b in self.best]))
        mine = held[held >= self.seen]
        if len(mine):
            k = mine - self.seen
            some = ids.take(pa.array(k))
            null = some.is_null().to_numpy(zero_copy_only=False)
            self.ids.append(np.stack([mine, np.asarray(some.fill_null(0)), null.astype(np.int64), rid[k]]))
        if sum(x.shape[1] for x in self.ids) > 4 * len(held) + CHUNK:
            every = np.concatenate(self.ids, axis=1)
            self.ids = [every[:, np.isin(every[0], held)]]

    def found(self, schema: pa.Schema):
        self.compare()
        if not self.ids:
            return
        every = np.concatenate(self.ids, axis=1)
        for k, best in enumerate(self.best):
            who, place = np.nonzero(best.at >= 0)
            if not len(who):
                continue
            at = np.searchsorted(every[0], best.at[who, place])
            score = [int(x) for x in best.score[who, place].tolist()]
            columns = [
                pa.array(self.rid[who]), pa.array(np.full(len(who), k, np.int32)), pa.array(every[1][at], mask=every[2][at].astype(bool)), pa.array(every[3][at]),
                pa.array([x if x in NARROW else None for x in score], pa.int64()), pa.array([self.layout.ordered(x) for x in score], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


class Positives(Search):
    """The best other rows of the anchor's own label."""

    def start(self) -> None:
        floor = np.full(len(self.rid), -(1 << 62) if not self.layout.wide else -(1 << 4000), dtype=self.layout.number)
        self.best = [Best(len(self.rid), self.layout.number, floor)]

    def feed(self, tile: slice, score, rid, label) -> None:
        ok = (self.label[tile][:, None] == label) & (self.rid[tile][:, None] != rid)
        self.best[0].feed(tile, score, ok, self.seen)


class Negatives(Search):
    """For each of the anchor's positives (their scores are ``wants``), the
    best rows of other labels between LEAST percent of that score and it."""

    def start(self) -> None:
        number = self.layout.number
        self.high, self.best = [], []
        for k in range(FEW):
            high = [self.layout.score_of(w[k]) if k < len(w) else -1 for w in self.wants]
            low = [-(-x * LEAST // 100) for x in high]  # the least score, rounded up
            self.high.append(np.array(high, dtype=number))
            self.best.append(Best(len(self.rid), number, np.array(low, dtype=number) - 1))

    def feed(self, tile: slice, score, rid, label) -> None:
        other = self.label[tile][:, None] != label
        for high, best in zip(self.high, self.best, strict=True):
            # a negative positive score leaves no room between its bounds
            best.feed(tile, score, other & (score <= high[tile][:, None]).astype(bool) & (high[tile] >= 0).astype(bool)[:, None], self.seen)


def hard_negatives(vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: Column | None = None, block_bytes: int = BLOCK_BYTES, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score. ``anchor``: which rows are
    anchors; ``label``: the label to compare (default the column)."""
    spark = vectors.sparkSession
    value = label if label is not None else F.col("label")
    rows = numbered(vectors, F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vec"), value.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"))

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE == float("inf"))

    good = rows.filter(F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", bad))
    ends = [F.max(F.array_max("vec").cast("double")).alias("high"), F.min(F.array_min("vec").cast("double")).alias("low")]
    s = good.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("vec")).alias("dims"), *ends).first()
    schema = "anchor_rid long, k int, id long, rid long, score long, key string"
    dims = max(1, s["dims"] or 0)
    low, high = (int(np.floor(SCALE * x)) for x in (min(0.0, s["low"] or 0.0), max(0.0, s["high"] or 0.0)))
    layout = Kronecker(low, max(high, low + 1), dims)
    blocks = max(1, -(-s["anchors"] * dims * 8 // block_bytes))
    parts = max(1, -(-s["n"] // part_rows), -(-2 * spark.sparkContext.defaultParallelism // blocks))
    anchors = good.filter("anchor").select("rid", "id", "vec", "label")

    def first_few(found: DataFrame, *by: str) -> DataFrame:
        order = W.partitionBy(*by).orderBy(F.desc("key"), F.col("id").isNull(), "id", "rid")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= FEW)

    none = F.array().cast("array<string>").alias("wants")
    found = _cells(anchors.select("rid", "label", "vec", none), good.select("rid", "id", "label", "vec"), blocks, parts, layout, Positives, schema)
    positives = store(first_few(found, "anchor_rid").select("anchor_rid", (F.col("rank") - 1).alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "key"), "positives")
    wants = positives.groupBy(F.col("anchor_rid").alias("rid")).agg(F.sort_array(F.collect_list(F.struct("k", "key"))).alias("w"))  # FEW at most
    seekers = anchors.join(wants, "rid").select("rid", "label", "vec", F.transform("w", lambda x: x["key"]).alias("wants"))
    found = _cells(seekers, good.select("rid", "id", "label", "vec"), blocks, parts, layout, Negatives, schema)
    negatives = first_few(found, "anchor_rid", "k").select("anchor_rid", "k", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select(F.col("rid").alias("anchor_rid"), F.col("id").alias("anchor_id"))
    out = negatives.join(positives, ["anchor_rid", "k"]).join(named, "anchor_rid")
    out = store(out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score"), "negatives")
    drop(positives)
    return out
