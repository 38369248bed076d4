"""Substring dedup, line dedup, fingerprints and packing against plain
versions and exact round trips."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohort_features.llm import lines, packing, sketch, substring, whole_lines
from cohort_features.llm.common import numbered, store
from cohort_features.llm.links import components, connect
from tests.llm import brute
from tests.llm.conftest import edited, stored, words

# --- lines ---------------------------------------------------------------------


def plain_simhashes(words, seeds):
    h = lines.line_words(" ".join(dict.fromkeys(words)))[0]
    out = []
    for s in range(seeds):
        g = [int(x) for x in lines.mix(h + np.uint64((s + 1) * int(lines.STEP) & (2**64 - 1)))]
        ones = [2 * sum(x >> b & 1 for x in g) for b in range(64)]
        out.append(sum(1 << b for b in range(64) if ones[b] > len(g) or ones[b] == len(g) and g[0] >> b & 1))
    return out


def plain_line_groups(rows):
    """(doc_id, line) -> first (doc_id, line) of its group, for grouped lines:
    all pairs that agree in a block, have near signs, and are similar."""
    at = defaultdict(list)
    for i, text in rows:
        for no, w in enumerate(lines.normalised(text)):
            if len(w) >= lines.MIN_WORDS:
                at[tuple(w)].append((i, no))
    keys = list(at)
    seeds, blocks, bits = lines.tables(len(keys))
    sims = [plain_simhashes(k, seeds + 2) for k in keys]
    u = brute.Union()
    for a in range(len(keys)):
        for b in range(a):
            differ = [x ^ y for x, y in zip(sims[a], sims[b], strict=True)]
            meet = any((x >> k * bits) % 2**bits == 0 for x in differ[:seeds] for k in range(blocks))
            if meet and sum(x.bit_count() for x in differ[seeds:]) <= lines.SIGN_BITS and sum(x.bit_count() for x in differ[:seeds]) <= lines.SHARE * 64 * seeds:
                longer = max(len(keys[a]), len(keys[b]))
                if 1 - brute.edit_distance(keys[a], keys[b]) / longer >= lines.SIMILARITY - 1e-9:
                    u.join(a, b)
    groups = defaultdict(list)
    for k, key in enumerate(keys):
        groups[u.find(k)] += at[key]
    return {x: min(g) for g in groups.values() if len(g) > 1 for x in g}


def test_words_of_lines_are_the_patterns(monkeypatch):
    monkeypatch.setattr(lines, "BLOCK_CHARS", 64)
    lines._powers.cache_clear()
    rng = random.Random(1)
    signs = ["ab", "B", "É", "1", "²", "٣", "_", "\n", " ", "-", "漢", "\U0001f600", "İ", "x9y", "\u0301", "\r"]
    seen: dict = {}
    for _ in range(1500):
        t = "".join(rng.choice(signs) for _ in range(rng.randrange(90)))
        h, no = lines.line_words(t)
        want = [(k, w) for k, ws in enumerate(lines.normalised(t)) for w in ws]
        assert no.tolist() == [k for k, _ in want]
        assert all(seen.setdefault(w, x) == x for (_, w), x in zip(want, h.tolist(), strict=True))
    lines._powers.cache_clear()
    assert len(set(seen.values())) == len(seen)


def test_most_similar_lines_meet(spark):
    """Recall and precision against every pair of edit similarity 0.8."""
    from cohort_features.llm.common import documents

    docs = documents(spark, "/root/testdata/sf0.01")

    def groups(df):
        return {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in df.collect()}

    got, want = groups(lines.duplicate_lines(docs)), groups(whole_lines.all_duplicate_lines(docs))
    assert set(got) <= set(want)
    assert sum(got.get(k) == v for k, v in want.items()) >= 0.97 * len(want)
    # of the lines without an equal one, which only near copies bring in
    texts = {r["doc_id"]: lines.normalised(r["text"]) for r in docs.select("doc_id", "text").collect()}
    count = Counter(tuple(w) for ws in texts.values() for w in ws)
    near = [k for k in want if count[tuple(texts[k[0]][k[1]])] == 1]
    assert len(near) > 100 and sum(k in got for k in near) >= 0.9 * len(near)


def test_no_near_line_is_left_out(spark):
    """Short lines with one word replaced, which share few SimHash blocks."""
    rng, rows = random.Random(31), []
    for i in range(400):
        words = [f"w{rng.randrange(10**6):x}x" for _ in range(rng.randrange(5, 9))]
        other = list(words)
        other[rng.randrange(len(other))] = f"e{i}y"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["keep_doc_id"] for r in lines.duplicate_lines(docs, complete=True).collect()}
    assert got == {i: i // 2 * 2 for i, _ in rows}


def test_tables_grow_with_the_lines():
    for n in (0, 1, 7_000, 10**6, 2_200_000, 10**8, 10**10, 10**13):
        seeds, blocks, bits = lines.tables(n)
        assert seeds * blocks < lines.BANDS and blocks * bits <= 64 and n < 2 ** (bits + 1)
        assert 1 - (1 - (1 - lines.DIFFER) ** bits) ** (seeds * blocks) >= lines.MEET


def test_line_groups_match_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_line_groups(rows)
    got = lines.duplicate_lines(docs)
    found = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in got.collect()}
    assert found == want and len(want) > 50
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["keep_doc_id"], r["keep_line_no"])) for r in got.collect())
    kept = {r["doc_id"]: r["text"] for r in lines.cleaned(docs, got).collect()}
    for i, text in rows:
        left = [x for no, x in enumerate(text.split("\n")) if want.get((i, no), (i, no)) == (i, no)]
        assert kept.get(i, "") == ("\n".join(left) if any(x.strip() for x in left) else "")


@pytest.mark.parametrize("screened", [256, 3])
def test_buckets_of_any_size(spark, monkeypatch, screened):
    """Hot keys, large buckets, and buckets over the edges of batches."""
    monkeypatch.setattr(lines, "SCREENED", screened)
    monkeypatch.setattr(lines, "HOT_ROWS", 5)
    monkeypatch.setattr(lines, "SAMPLED", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rng = random.Random(12)
    texts = []
    for _ in range(12):
        base = words(rng, 30)
        texts += [base, *(reworded(rng, base, rng.randrange(1, 4)) for _ in range(12))]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(texts)]
    got = lines.duplicate_lines(stored(spark, rows))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in got.collect()}
    assert found == plain_line_groups([r[:2] for r in rows]) and len(found) > 100


def test_a_pair_of_long_lines(spark):
    rng = random.Random(13)
    base = words(rng, 20_000, 10**6)
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate([base, edited(rng, base, 900), edited(rng, base, 1500), edited(rng, base, 9000)])]
    got = lines.duplicate_lines(stored(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == {0, 1, 2}


def test_edit_distance_bound():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(12))]
        d = brute.edit_distance(a, b)
        for most in range(6):
            assert lines.within(a, b, most) == (d <= most)


def test_lines_of_edge_rows(edge, empty):
    got = lines.duplicate_lines(edge).collect()
    assert Counter(r["line_no"] for r in got) == {0: 4, 1: 4}
    assert sum(r["kept"] for r in got) == 2 and {r["keep_doc_id"] for r in got} == {None}
    out = lines.cleaned(edge, lines.duplicate_lines(edge))
    assert out.columns == edge.columns and out.count() == 8
    assert lines.duplicate_lines(empty).count() == 0
    assert lines.cleaned(empty, lines.duplicate_lines(empty)).count() == 0


def plain_similar_groups(rows):
    """As ``plain_line_groups``, by edit similarity alone."""
    at = defaultdict(list)
    for i, text in rows:
        for no, w in enumerate(lines.normalised(text)):
            if len(w) >= lines.MIN_WORDS:
                at[tuple(w)].append((i, no))
    keys = list(at)
    u = brute.Union()
    for a in range(len(keys)):
        for b in range(a):
            longer, shorter = max(len(keys[a]), len(keys[b])), min(len(keys[a]), len(keys[b]))
            shared = sum((Counter(keys[a]) & Counter(keys[b])).values())  # edits leave 0.8 of the words
            if shorter >= 0.8 * longer - 1e-9 and shared >= 0.8 * longer - 1e-9:
                if 1 - brute.edit_distance(keys[a], keys[b]) / longer >= lines.SIMILARITY - 1e-9:
                    u.join(a, b)
    groups = defaultdict(list)
    for k, key in enumerate(keys):
        groups[u.find(k)] += at[key]
    return {x: min(g) for g in groups.values() if len(g) > 1 for x in g}


def reworded(rng, w, changes):
    """``w`` with a word replaced, put in or taken out for each change."""
    w = list(w)
    for _ in range(changes):
        k = rng.randrange(len(w) + 1)
        w[k : k + rng.randrange(2)] = rng.choice([[], ["x" + "abcdefgh"[rng.randrange(8)]]])
    return w


@pytest.mark.parametrize("screened", [256, 3])
def test_every_line_of_edit_similarity_is_found(spark, monkeypatch, screened):
    monkeypatch.setattr(whole_lines, "SCREENED", screened)
    rng = random.Random(31)
    texts = []
    for _ in range(90):
        w = words(rng, rng.randrange(3, 40), 60)  # few words, so unlike lines share pairs
        texts += [w, *(reworded(rng, w, rng.randrange(1, max(2, len(w) // 5 + 1))) for _ in range(rng.randrange(3)))]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(texts)]
    table = stored(spark, rows)
    want = plain_similar_groups([r[:2] for r in rows])
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in whole_lines.all_duplicate_lines(table).collect()}
    assert got == want and len(want) > 20


def test_prefixes_of_similar_lines_meet():
    rng = random.Random(32)
    levels = np.zeros(whole_lines.BINS, dtype=np.uint8)
    for _ in range(1500):
        a = words(rng, rng.randrange(4, 60), 30)
        b = reworded(rng, a, rng.randrange(1, 14))
        if a != b and lines.similar(a, b):
            h, starts, sizes = whole_lines._flat([a, b])
            keys, line = whole_lines.prefix_keys(h, sizes, levels, lines.SIMILARITY)
            assert set(keys[line == 0].tolist()) & set(keys[line == 1].tolist())
            sign = whole_lines.signs(h, starts, sizes)
            assert whole_lines._may_link(sign[0], sign[1], lines.SIMILARITY)


@pytest.mark.parametrize("together,screened", [(1, 3), (7, 3), (1 << 15, 256)])
def test_buckets_of_repeated_keys(spark, monkeypatch, together, screened):
    monkeypatch.setattr(whole_lines, "TOGETHER", together)
    monkeypatch.setattr(whole_lines, "SCREENED", screened)
    rng = random.Random(33)
    sign = {i: rng.choice([0, 1, 3, (1 << 40) - 1]) for i in range(60)}  # lines of ten words: two edits flip four parities
    some = [(rng.randrange(12) ** 2, rng.randrange(60)) for _ in range(400)]
    rows = [(k, i, sign[i], 10 << 48) for k, i in some]
    found = whole_lines.likely_buckets(spark.createDataFrame(rows, "key long, id long, sign0 long, sign1 long"), lines.SIMILARITY)
    got = [(r["key"], r["id"]) for r in found.collect()]
    near = {(k, i) for k, i in some for m, j in some if k == m and i != j and (sign[i] ^ sign[j]).bit_count() <= 4}
    assert len(got) == len(set(got)) and near <= set(got) <= set(some) and (screened < 256 or set(got) == near)


def test_keys_are_shuffled_once_and_not_stored(spark):
    rng = random.Random(34)
    table = stored(spark, [(i, " ".join(words(rng, 12, 40)), "en", "s", 0) for i in range(50)])
    rows = numbered(table, "doc_id", "text")
    written = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(whole_lines, "store", lambda df, name: written.append((name, df)) or store(df, name))
        whole_lines.with_missed(rows, lines.line_table(rows, 1).select("rid", "doc_id", "line_no", "id"), components(spark.createDataFrame([], "u long, v long")), 1, lines.SIMILARITY)
    name, first = written[0]
    assert name == "members" and first._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_keys_are_dealt_over_the_passes(spark):
    rng = random.Random(35)
    table = stored(spark, [(i, " ".join(words(rng, 12, 40)), "en", "s", 0) for i in range(50)])
    levels = np.zeros(whole_lines.BINS, dtype=np.uint8)

    def keys(*part):
        return Counter((r["key"], r["id"]) for r in whole_lines.line_keys(table, 1, levels, lines.SIMILARITY, *part).collect())

    parts = [keys(p, whole_lines.PASSES) for p in range(whole_lines.PASSES)]
    every = keys()
    assert sum(parts, Counter()) == every and max(len(p) for p in parts) < 0.7 * len(every)


def test_a_bucket_falls_into_sets_of_near_lines(spark):
    sign = {1: 0, 2: 1, 3: 3, 10: (1 << 40) - 1, 11: (1 << 41) - 1, 20: ((1 << 20) - 1) << 41}  # lines of ten words: two edits flip four parities
    rows = [(7, i, s, 10 << 48) for i, s in sign.items()]
    found = whole_lines.likely_buckets(spark.createDataFrame(rows, "key long, id long, sign0 long, sign1 long"), lines.SIMILARITY)
    sets = {}
    for r in found.collect():
        sets.setdefault(r["set"], set()).add(r["id"])
    assert sorted(map(sorted, sets.values())) == [[1, 2, 3], [10, 11]]


def test_word_signs_keep_similar_lines_and_part_long_unlike_ones():
    rng = random.Random(36)

    def sign(w):
        return whole_lines.word_sign(whole_lines.mix(whole_lines._flat([w])[0] ^ whole_lines.STEP))

    near = 0
    for _ in range(300):
        a = words(rng, rng.randrange(4, 140), 30)
        b = reworded(rng, a, rng.randrange(1, 14))
        if lines.similar(a, b):
            near += 1
            assert whole_lines.near_pairs(np.zeros(2, np.int64), [sign(a), sign(b)], lines.SIMILARITY)[0].tolist() == [0]
    assert near > 100
    held = [sign(words(rng, rng.randrange(190, 200), 10**6)) for _ in range(40)]  # 112 parities tell hardly any apart
    assert not len(whole_lines.near_pairs(np.zeros(40, np.int64), held, lines.SIMILARITY)[0])


def test_long_unlike_lines_that_share_word_pairs_are_not_read(spark, monkeypatch):
    """Lines of 120 words with some rare pairs in common; few of them are near."""
    rng = random.Random(37)
    texts = []
    for _ in range(3):
        pairs = words(rng, 12, 10**6)
        for _ in range(12):
            w = words(rng, 108, 10**6)
            at = rng.randrange(100)
            texts.append(w[:at] + pairs + w[at:])
    texts += [reworded(rng, texts[5], 6), reworded(rng, texts[20], 6)]
    table = stored(spark, [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(texts)])
    seen = []
    monkeypatch.setattr(whole_lines, "connect", lambda m, *rest: seen.append({r["id"] for r in m.collect()}) or connect(m, *rest))
    got = {(r["doc_id"], r["keep_doc_id"]) for r in whole_lines.all_duplicate_lines(table).collect()}
    assert got == {(5, 5), (36, 5), (20, 20), (37, 20)} and len(seen[0]) == 4


@pytest.mark.parametrize("sieved", [2, 2048])
def test_every_line_is_found_where_buckets_are_not_sieved(spark, monkeypatch, sieved):
    monkeypatch.setattr(whole_lines, "SIEVED", sieved)
    rng = random.Random(38)
    texts = []
    for _ in range(30):
        w = words(rng, rng.randrange(6, 60), 60)
        texts += [w, *(reworded(rng, w, rng.randrange(1, max(2, len(w) // 5 + 1))) for _ in range(rng.randrange(3)))]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(texts)]
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in whole_lines.all_duplicate_lines(stored(spark, rows)).collect()}
    assert got == plain_similar_groups([r[:2] for r in rows]) and len(got) > 10


def test_whole_lines_of_edge_rows(edge, empty):
    plain, whole = (f(edge).collect() for f in (lines.duplicate_lines, whole_lines.all_duplicate_lines))
    assert Counter(plain) == Counter(whole)
    assert whole_lines.all_duplicate_lines(empty).count() == 0


def test_short_lines_are_grouped_and_removed(spark):
    from cohort_features.llm import queries

    rows = [(i, f"Read more\n{' '.join(words(random.Random(i), 8, 10**6))}\n\npage {i}\nall rights {'' if i % 2 else 'now '}reserved", "en", "s", 0) for i in range(6)]
    table = stored(spark, rows)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "documents", lambda *_: table)
        got = queries.op3_lines(spark, "").collect()
    found = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in got}
    assert found == {(i, no): (i % 2 if no == 4 else 0, no) for i in range(6) for no in (0, 3, 4)}
    left = {r["doc_id"]: r["text"].split("\n") for r in lines.cleaned(table, lines.duplicate_lines(table)).collect()}
    assert [len(left[i]) for i in range(6)] == [5, 3, 2, 2, 2, 2]


# --- substring -----------------------------------------------------------------


def shared_passages(spark, n=40, length=51):
    rng = random.Random(21)
    passages = [words(rng, length, 10**6) for _ in range(n)]
    rows, planted = [], {}
    for k, p in enumerate(passages):
        for copy in range(2):
            before, after = words(rng, rng.randrange(0, 90), 10**6), words(rng, rng.randrange(0, 90), 10**6)
            i = 2 * k + copy
            rows.append((i, " ".join(before + p + after).replace(" ", "\n", 1), "en", "s", 0))
            planted[i] = (len(before), len(before) + length)
    rows += [(1000 + i, " ".join(words(rng, 120, 10**6)), "en", "s", 0) for i in range(40)]
    return stored(spark, rows), planted


def test_passages_of_51_words_are_found_and_nothing_else(spark):
    table, planted = shared_passages(spark)
    got = substring.repeated_passages(table).collect()
    found = {r["doc_id"] for r in got}
    assert not any(i >= 1000 for i in found)
    assert len(found & set(planted)) >= 0.97 * len(planted)
    for r in got:
        a, b = planted[r["doc_id"]]
        assert a - 3 <= r["start_word"] and r["start_word"] + r["n_words"] <= b + 3  # a near copy may take in a word more
        assert r["keep_doc_ids"] == [r["doc_id"] // 2 * 2]
        assert r["removed_words"] == (r["n_words"] if r["doc_id"] % 2 else 0)

def test_lines_are_cut_once(spark):
    docs = stored(spark, [(1, "a b\nc d"), (2, "e f")], "doc_id long, text string")
    gone = spark.createDataFrame([(r["rid"], 1, False) for r in numbered(docs, "doc_id").filter("doc_id = 1").collect()], "rid long, line_no long, kept boolean")
    out = lines.cleaned(docs, gone)
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a b"), (2, "e f")]


def test_texts_cut_together_as_one_by_one():
    texts = ["", "a", "a b", " \n ", None, "é b c d e\x85 f g " * 40, " ".join(f"w{k * k % 97}" for k in range(3000)), "q" * 40_000 + " t", "x y z w v u t s"]
    h, counts = substring.word_hashes_of(texts)
    alone = [substring.word_hashes(t) for t in texts]
    assert counts.tolist() == [len(x) for x in alone] and h.tolist() == np.concatenate(alone).tolist()
    begin = np.cumsum(counts) - counts
    at = substring.starts_of(h, counts=counts)
    assert at.tolist() == [a + b for x, b in zip(alone, begin.tolist(), strict=True) for a in substring.starts_of(x).tolist()]
    ids, low = substring.paragraph_hashes(h, at)
    parts = [substring.paragraph_hashes(x, substring.starts_of(x)) for x in alone if len(x)]
    assert ids.tolist() == np.concatenate([p[0] for p in parts]).tolist() and low.tolist() == np.concatenate([p[1] for p in parts], axis=1).tolist()


def test_paragraphs_worth_a_test_are_few_and_complete():
    """Of 3000 paragraphs with one common shingle, those alike are offered, and
    hardly others."""
    rng, matcher = np.random.default_rng(5), substring.ParagraphMatcher(80)
    kinds = [rng.integers(1, 1 << 63, size=n, dtype=np.uint64) for n in rng.integers(1, 25, size=500)]
    items = []
    for k in range(3000):
        x = kinds[k % 500].copy()
        x[rng.integers(len(x), size=k // 500 % 3)] = rng.integers(1, 1 << 63, dtype=np.uint64)
        items.append((np.array([7, k % 3, k % 2], dtype=np.uint64), np.unique(np.append(x, np.uint64(0)))))
    stacked, offered = matcher.stack(items), 0
    for one in items[::20]:
        for band in range(3):
            want = {k for k, x in enumerate(items) if matcher.link(x, one) and not (x[0][:band] == one[0][:band]).any()}
            got = matcher.screen(stacked, one, band)
            assert want <= set(got) and len(set(got)) == len(got)
            offered += len(got)
    assert offered < 150 * 3 * 40


def test_passage_shuffles_grow_with_the_texts(spark, tmp_path, monkeypatch):
    """No join of the search is a broadcast at a small size and a shuffle at a large one."""
    def counted(*_, **__):
        raise AssertionError("a join that changes with the size")

    monkeypatch.setattr(substring, "join_small", counted)
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.createDataFrame([(k, f"{' '.join(f'd{k}x{j}' for j in range(30))} {passage} {' '.join(f'e{k}x{j}' for j in range(30))}") for k in range(4)], "doc_id long, text string")
    found = substring.repeated_passages(docs).collect()
    assert sorted((r["doc_id"], r["start_word"], r["n_words"]) for r in found) == [(k, 30, 60) for k in range(4)]


def test_removed_words_follow_a_plain_version(docs):
    """Paragraphs compared pair by pair, groups by union, runs by a loop."""
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    paras = []
    for i, text in rows:
        w = brute.ascii_words(text)
        h = substring.word_hashes(text)
        at = [*substring.starts_of(h).tolist(), len(w)]
        paras += [(i, a, b, brute.shingle_set(" ".join(w[a:b]), 5), tuple(w[a:b])) for a, b in zip(at, at[1:], strict=False)]
    u = brute.Union()
    for x in range(len(paras)):
        for y in range(x):
            s, t = paras[x][3], paras[y][3]
            if paras[x][4] == paras[y][4] or (s & t and 100 * len(s & t) >= 80 * len(s | t)):
                u.join(x, y)
    docs_of = defaultdict(set)
    for x, p in enumerate(paras):
        docs_of[u.find(x)].add(p[0])
    want = plain_passages(rows, paras, [u.find(x) for x in range(len(paras))], docs_of)
    got = {(r["doc_id"], r["start_word"]): (r["n_words"], r["removed_words"]) for r in substring.repeated_passages(docs).collect()}
    assert len(set(got) - set(want)) <= 0.02 * len(want)
    agree = sum(got.get(k) == v for k, v in want.items())
    assert len(want) > 30 and agree >= 0.98 * len(want)  # MinHash recall is 0.992 at the threshold


def plain_passages(rows, paras, comp, docs_of):
    """(doc, first word) -> (words, removed words), by loops over words."""
    word = {i: brute.ascii_words(t) for i, t in rows}
    runs, places = [], defaultdict(list)  # runs: [doc, start, end, first comp, last comp, keepers, removed]
    for x, (i, a, b, _, _) in enumerate(paras):
        if len(docs_of[comp[x]]) < 2:
            continue
        keep = min(docs_of[comp[x]])
        places[comp[x]].append((i, a, b))
        if not runs or runs[-1][0] != i or runs[-1][2] != a:
            runs.append([i, a, a, comp[x], None, set(), 0])
        r = runs[-1]
        r[2], r[4] = b, comp[x]
        r[5].add(keep)
        r[6] += (b - a) * (keep != i)
    before = [p[2] if p and p[0] == r[0] else 0 for p, r in zip([None, *runs], runs, strict=False)]
    after = [n[1] if n and n[0] == r[0] else len(word[r[0]]) for r, n in zip(runs, [*runs[1:], None], strict=True)]

    def beside(i, at, room, side):
        room = min(room, substring.REACH)
        return tuple(word[i][at - room : at][::-1] if side else word[i][at : at + room])

    answers = defaultdict(list)
    for r, p, n in zip(runs, before, after, strict=True):
        answers[r[4], 0].append((r[0], beside(r[0], r[2], n - r[2], 0)))
        answers[r[3], 1].append((r[0], beside(r[0], r[1], r[1] - p, 1)))
    for c, at in places.items():
        for i, a, b in (min(at), max(at)):
            answers[c, 0].append((i, beside(i, b, len(word[i]) - b, 0)))
            answers[c, 1].append((i, beside(i, a, a, 1)))

    def grown(i, c, side, own):
        for k in range(len(own), 0, -1):
            with_it = {j for j, w in answers[c, side] if w[:k] == own[:k]}
            if len(with_it) > 1:
                return k, min(with_it)
        return 0, i

    out, passage, to = {}, None, {}
    for r, p, n in zip(runs, before, after, strict=True):
        i, start, end, first, last, keepers, gone = r
        more, keep = grown(i, last, 0, beside(i, end, n - end, 0))
        less, kept = grown(i, first, 1, beside(i, start, start - p, 1))
        b = end + more
        a = max(start - less, to.get(i, 0))
        keepers = keepers | ({keep} if more else set()) | ({kept} if a < start else set())
        gone += more * (keep != i) + (start - a) * (kept != i)
        same = False
        if passage and passage[0] == i:
            gap, one = a - passage[2], b - passage[3] - 4
            same = gap == 0 or keepers & passage[4] and 100 * (one - gap - 4) >= 80 * (one + gap + 4)
        first_word = passage[1] if same else a
        n_words, removed = out.get((i, first_word), (0, 0))
        out[i, first_word] = (b - first_word, removed + gone)
        passage, to[i] = (i, first_word, b, a, keepers), b
    return {k: v for k, v in out.items() if v[0] >= substring.MIN_WORDS}


@pytest.mark.parametrize(("length", "changes", "share"), [(60, 0, 0.95), (60, 1, 0.85), (100, 2, 0.9)])
def test_edited_passages_are_found_by_documents_and_words(spark, length, changes, share):
    """Passages of which each document has its own edited copy: 0.9 of the
    documents and a share of the passages' words are reported, hardly any other
    word. What is lost are short ends beyond an edited word."""
    rng = random.Random(17 + length + changes)
    rows, planted = [], {}
    for k in range(8):
        base = words(rng, length, 10**6)
        for copy in range(10):
            w = list(base)
            for at in rng.sample(range(length), changes):
                w[at] = f"changed{rng.randrange(10**6)}"
            before, after = words(rng, rng.randrange(0, 90), 10**6), words(rng, rng.randrange(0, 90), 10**6)
            i = 100 * k + copy
            rows.append((i, " ".join([*before, *w, *after]), "en", "s", 0))
            planted[i] = (len(before), len(before) + length)
    got = substring.repeated_passages(stored(spark, rows)).collect()
    reported = {i: set() for i in planted}
    for r in got:
        reported[r["doc_id"]] |= set(range(r["start_word"], r["start_word"] + r["n_words"]))
    inside = {i: len(reported[i] & set(range(*planted[i]))) for i in planted}
    assert sum(n > 0 for n in inside.values()) >= 0.9 * len(planted)
    assert sum(inside.values()) >= share * length * len(planted)
    assert sum(len(reported[i]) - inside[i] for i in planted) <= 0.02 * length * len(planted)


def test_passages_are_cut_from_the_text(spark):
    table, planted = shared_passages(spark, n=5, length=60)
    passages = substring.repeated_passages(table)
    before = {r["doc_id"]: r["text"].split() for r in table.collect()}
    after = {r["doc_id"]: r["text"].split() for r in substring.without_passages(table, passages).collect()}
    removed = {r["doc_id"]: (r["start_word"], r["n_words"]) for r in passages.collect() if r["removed_words"]}
    assert removed
    for i, w in before.items():
        a, n = removed.get(i, (0, 0))
        assert after[i] == w[:a] + w[a + n :]


def test_substring_of_edge_rows(edge, empty):
    got = substring.repeated_passages(edge).collect()
    assert got == []  # sixteen shared words are under the twenty
    low = substring.repeated_passages(edge, min_words=10).collect()
    assert Counter(r["doc_id"] for r in low) == {None: 1, 6: 2, 7: 1}
    assert {r["removed_words"] for r in low if r["doc_id"] is None} == {0}
    assert substring.repeated_passages(empty).count() == 0
    out = substring.without_passages(edge, substring.repeated_passages(edge, min_words=10))
    assert out.columns == edge.columns and out.count() == 11


# --- fingerprints --------------------------------------------------------------


def jaccard(a, b, k=5):
    a, b = brute.shingle_set(a, k), brute.shingle_set(b, k)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts_and_likeness(docs):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r for r in sketch.edited_fingerprints(docs).collect()}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        new = t[: len(t) - cut] + nxt[:cut]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert abs(r["near_edited"] - jaccard(t, new)) < 0.2 and abs(r["near_next"] - jaccard(t, nxt)) < 0.2
        if len(brute.shingle_set(t, 5) | brute.shingle_set(new, 5)) <= sketch.K:
            assert abs(r["near_edited"] - jaccard(t, new)) < 1e-12
        assert r["n_distinct"] == pytest.approx(len(brute.shingle_set(t, 5)), rel=0.4)
    equal = defaultdict(set)
    for i, t in rows:
        equal[t].add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in equal.values())


def test_sketches_merge():
    rng = random.Random(6)
    a, b = " ".join(words(rng, 900)), " ".join(words(rng, 300))
    sa, sb = sketch.sketch(a), sketch.sketch(b)
    whole = np.union1d(sketch.shingle_set(a, 5), sketch.shingle_set(b, 5))[: sketch.K]
    assert (sketch.merge(sa, sb) == whole).all()
    assert (sketch.from_text(sketch.to_text(sa)) == sa).all()
    part = " ".join(a.split()[:300])
    assert sketch.containment(sketch.sketch(part), sa) > 0.8 > 0.5 > sketch.containment(sa, sketch.sketch(part))


def test_fingerprints_of_edge_rows(edge, empty, spark):
    got = sketch.edited_fingerprints(edge).collect()
    assert len(got) == 11
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert [by[i][0]["n_chars"] for i in (1, 2, 3)] == [0, 0, 4]
    assert by[1][0]["fingerprint"] == "" and by[1][0]["near_next"] == 1.0 and by[3][0]["near_next"] == 0.0
    assert by[6][0]["fingerprint"] == by[6][1]["fingerprint"] == by[7][0]["fingerprint"]
    assert sketch.edited_fingerprints(empty).count() == 0
    one = stored(spark, [(5, "abcdefgh", "en", "s", 8)], files=1)
    (r,) = sketch.edited_fingerprints(one).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


# --- packing -------------------------------------------------------------------


def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(pieces, ids, length=2048):
    pieces = sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for r in pieces:
        assert r["sequence_id"] * length + r["offset"] == at  # gapless, full but for the last
        at += r["length"]
    total = Counter()
    for r in pieces:
        x = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(x) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(np.array(x, dtype="<u4").tobytes()) == r["ids_crc32"]
        assert np.frombuffer(r["ids"], "<u2").tolist() == x
        total[r["doc_id"]] += r["length"]
    assert total == {i: len(x) for i, x in ids.items()}


def test_packed_ids_are_the_tokenizers(docs, spark):
    odd = ["a  b", "x \n y", " lead", "trail ", "\n\n", "it's <|endoftext|> here", "tab\tand space   three", "\0 a\0b c\0", "a　b 漢字 \U0001f600", "don't  ", "  "]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_000 + k, t) for k, t in enumerate(odd)]
    table = stored(spark, [(i, t, "en", "s", 0) for i, t in rows], files=3)
    tk = tokenizer()
    ids = {i: [*tk.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}
    check_pieces(packing.pack(table).collect(), ids)
    check_pieces(packing.pack(table, length=64).collect(), ids, 64)


def test_encoder_equals_tokenizer_on_random_texts():
    rng = random.Random(8)
    tk, enc = tokenizer(), packing.encoder(packing._default_ranks())
    signs = [" ", " ", " ", "\n", "\t", "a", "B", "é", "1", "23", "'s", ".", "...", "!!", " ", "word", "\0", "漢", "-"]
    for _ in range(2000):
        t = "".join(rng.choice(signs) for _ in range(rng.randrange(25)))
        assert np.frombuffer(enc(t), "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids, repr(t)


def test_packing_of_edge_rows(edge, empty):
    got = packing.pack(edge).collect()
    assert sum(r["start"] == 0 for r in got) == 11
    assert all(r["doc_tokens"] == 1 and r["length"] == 1 for r in got if r["doc_id"] in (1, 2))
    assert packing.pack(empty).count() == 0
