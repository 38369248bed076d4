"""SetSketch near-duplicates, the link engine and the exact operators against
brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_features.llm import exact, links, minhash
from cohort_features.llm.common import store
from cohort_features.llm.words import ascii_words, overlap, shingle_set, word_hashes
from tests.llm import brute
from tests.llm.conftest import corpus, edited, stored, words


def test_words_are_the_contracts_words():
    text = "The ÉTÉ\x0bX y Z\x1c q\r\nAB"
    assert [w.decode() for w in ascii_words(text)] == brute.ascii_words(text)
    rng = random.Random(7)
    seen: dict[str, int] = {}
    for n in (*range(30), 300_000):  # the last is longer than a block
        t = "".join(rng.choice(["a", "B", "é", "É", " ", "\n", "\x1c", "\x85", "zz", "\u3000"]) for _ in range(n))
        t = t + "x" * n if n > 1000 else t  # and ends in a word longer than one
        plain, hashes = brute.ascii_words(t), word_hashes(t).tolist()
        assert len(plain) == len(hashes)
        assert all(seen.setdefault(w, h) == h for w, h in zip(plain, hashes, strict=True))
    assert len(set(seen.values())) == len(seen)


def test_shingle_sets_have_the_sizes_of_exact_sets():
    for _, text, *_ in corpus(docs=20):
        for k in (3, 5):
            assert len(shingle_set(text, k)) == len(brute.shingle_set(text, k))


def test_sketch_merges_and_estimates():
    rng = random.Random(1)
    a = words(rng, 600, 10**6)
    b = a[:500] + words(rng, 100, 10**6)
    sa, sb = shingle_set(" ".join(a), 3), shingle_set(" ".join(b), 3)
    ra, rb = minhash.registers(sa), minhash.registers(sb)
    assert (minhash.merged(ra, rb) == minhash.registers(np.union1d(sa, sb))).all()
    both = overlap(sa, sb)
    true = both / (len(sa) + len(sb) - both)
    est = minhash.joint_estimate(ra[None, :], np.array([len(sa)]), rb, len(sb))[0]
    assert abs(est - true) < 0.12


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_groups_match_brute_force(docs, size, percent):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, sets = brute.near_groups(rows, size, percent)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, size, percent).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert sum(r["stays"] for r in got.values()) == sum(r["kept"] for r in got.values()) == len(set(want.values()))


def test_large_group_of_near_copies_of_mixed_distance(spark):
    rng = random.Random(9)
    base = words(rng, 60)
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 9))), "en", "src0", 0) for i in range(300)]
    table = stored(spark, rows)
    want, _ = brute.near_groups([(r[0], r[1]) for r in rows], 3, 85)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(table, 3, 85).collect()}
    assert got == want


def test_near_duplicates_of_edge_rows(edge, empty):
    got = minhash.near_duplicates(edge, 3, 85).collect()
    assert len(got) == 11
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert [r["n_shingles"] for r in by[1] + by[2] + by[3]] == [0, 0, 0]
    assert by[4][0]["n_shingles"] == 1 and by[5][0]["n_shingles"] > 59_000
    assert {r["component_id"] for r in by[6] + by[7]} == {6}
    assert sorted(r["component_id"] for r in by[None] if r["component_id"]) == [6]
    assert sum(r["stays"] for r in by[6] + by[7] + by[None]) == 2  # one of the group; the null text stays
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    rng.shuffle(edges)
    u = brute.Union()
    for a, b in edges:
        u.join(a, b)
    got = {r["id"]: r["comp"] for r in links.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: u.find(x) for x in u.parent if u.find(x) != x or any(u.find(y) == x and y != x for y in u.parent)}
    assert links.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shared_buckets_over_batch_borders(spark):
    rng = random.Random(12)
    rows = [(rng.randrange(60), rng.randrange(8)) for _ in range(400)] + [(100, k) for k in range(50)] + [(200, 3)] * 40
    want = {(k, i) for k, i in rows if len({j for q, j in rows if q == k}) > 1}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in ("3", "1", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            got = [(r["key"], r["id"]) for r in links.shared_buckets(spark.createDataFrame(rows, "key long, id long")).collect()]
            assert len(got) == len(set(got)) and set(got) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


class Near(links.Matcher):
    """Numbers link if they differ by one at most."""

    def prepare(self, payload):
        return int(payload)

    def stack(self, items):
        return items

    def screen(self, stacked, item, band):
        return range(len(stacked))

    def link(self, a, b):
        return abs(a - b) <= 1


def test_connect_finds_links_that_miss_the_leader(spark, monkeypatch):
    monkeypatch.setattr(links, "SALT_ROWS", 4)
    monkeypatch.setattr(links, "BATCH_BYTES", 16)
    values = {i: v for i, v in enumerate([50, 1, 2, 3, 10, 11, 30, 51, 12, 70])}
    members = store(spark.createDataFrame([(1, 0, i) for i in values], "key long, band int, id long"), "m")
    payload = store(spark.createDataFrame([(i, str(v).encode()) for i, v in values.items()], "id long, payload binary"), "p")
    got = {r["id"]: r["comp"] for r in links.connect(members, payload, Near()).collect()}
    assert got == {0: 0, 7: 0, 1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 4}


def test_connect_does_not_test_what_is_known(spark):
    values = {0: 5, 1: 5, 2: 6, 3: 40, 4: 41, 5: 80}
    comp = {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 0}
    members = [(1, 0, i, comp[i]) for i in values if i < 3] + [(2, 1, i, comp[i]) for i in (2, 3, 4)]
    members = store(spark.createDataFrame(members, "key long, band int, id long, comp long"), "m")
    payload = store(spark.createDataFrame([(i, str(v).encode()) for i, v in values.items()], "id long, payload binary"), "p")
    known = store(spark.createDataFrame([(i, c) for i, c in comp.items() if i < 3 or i == 5], "id long, comp long"), "k")
    asked = []
    with pytest.MonkeyPatch.context() as m:
        real = links._tested
        m.setattr(links, "_tested", lambda rows, *rest: asked.append({(r["batch"], r["id"]) for r in rows.filter("role = 1").collect()}) or real(rows, *rest))
        got = {r["id"]: r["comp"] for r in links.connect(members, payload, Near(), known).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 5: 0, 3: 3, 4: 3}
    assert asked[0] == {(2, 3), (2, 4)}  # nothing of the bucket that is one component already


def test_exact_duplicates_match_a_dictionary(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    for size in (7, 1024):  # many levels of names, and few
        got = {r["doc_id"]: r for r in exact.exact_duplicates(docs, size).collect()}
        for i, t in rows:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (max(groups[t]), len(groups[t]), i == max(groups[t]))
            assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_hot_blocks_are_named_apart(docs, monkeypatch):
    for module in (exact,):
        monkeypatch.setattr(module, "HOT_ROWS", 1)
    want = {r["doc_id"]: r["keep_id"] for r in exact.exact_duplicates(docs, 40).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    last = {}
    for i, t in sorted(texts.items()):
        last[t] = i
    assert want == {i: last[t] for i, t in texts.items()}


def test_exact_duplicates_of_edge_rows(edge, empty):
    got = exact.exact_duplicates(edge).collect()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert len(got) == 11
    assert {r["group_size"] for r in by[1] + by[2]} == {3}  # null and empty texts are one group
    assert {r["keep_id"] for r in by[6] + by[7]} == {7} and sum(r["kept"] for r in by[6] + by[7]) == 1
    assert by[3][0]["group_size"] == 1
    assert exact.exact_duplicates(empty).count() == 0


def test_with_group_hot_keys(spark, monkeypatch):
    from cohort_features.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    table = store(spark.createDataFrame([(k, i) for i, k in enumerate([1] * 10 + [2] * 2 + [3])], "k long, x long"), "t")
    got = common.with_group(table, "k", [F.max("x").alias("m")]).collect()
    assert sorted((r["k"], r["x"], r["m"]) for r in got) == sorted((k, i, {1: 9, 2: 11, 3: 12}[k]) for i, k in enumerate([1] * 10 + [2] * 2 + [3]))


def test_few_rows_travel_as_arrow(spark, monkeypatch):
    """Rows given as a list are made by Python workers of their own."""
    import pyarrow as pa

    from cohort_features.llm import common, mixing

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    table = store(spark.createDataFrame([(1, i) for i in range(10)], "k long, x long"), "t")
    docs = store(spark.createDataFrame([(i, f"a b {i}", "en", "web") for i in range(20)], "doc_id long, text string, lang string, source string"), "docs")
    made, create = [], type(spark).createDataFrame

    def seen(self, data, *args, **kwargs):
        made.append(type(data))
        return create(self, data, *args, **kwargs)

    monkeypatch.setattr(type(spark), "createDataFrame", seen)
    first = common.with_group(table, "k", [F.min(F.struct("x", "k")).alias("first")]).collect()
    assert sorted((r["x"], r["first"]["x"], r["first"]["k"]) for r in first) == [(i, 0, 1) for i in range(10)]
    assert mixing.mix(docs).count() >= 20
    assert len(made) >= 2 and set(made) == {pa.Table}
    assert common.few_rows(spark, [], "a array<string>, n int").collect() == []
