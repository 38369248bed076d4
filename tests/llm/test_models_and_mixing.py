"""Quality, language, personal data and mixing: held-out accuracy, plain
versions, edge rows; and the pipeline's stages."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_features.llm import language, mixing, pii, quality
from cohort_features.llm.common import documents
from cohort_features.llm.words import mix
from tests.conftest import SF_SMALL
from tests.llm.conftest import stored

SF = "/root/testdata/sf0.01"

# --- quality -------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got.values())
    held = [(got[r["doc_id"]], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert held and all(r["held_out"] for r, _ in held)
    assert sum(r["predicted"] == y for r, y in held) >= 0.9 * len(held)
    assert sum(r["held_out"] for r in got.values()) == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in got)
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, other).collect()}
    assert again == pytest.approx({i: r["score"] for i, r in got.items()}, abs=1e-6)  # held-out labels are not read


def test_word_vectors_match_a_loop(docs):
    want = np.zeros((quality.ROWS, quality.DIM))
    for r in docs.collect():
        h = quality.token_hashes(r["text"])
        rows, shape = quality._row(h), (h & np.uint64(7)).astype(int)
        index = quality.index_vectors(h)
        for i in range(len(h)):
            for j in range(max(0, i - quality.WINDOW), min(len(h), i + quality.WINDOW + 1)):
                if i != j:
                    want[rows[i]] += index[j]
                    want[quality.SHAPE_ROWS[shape[i]]] += index[j]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(quality.word_vectors(docs), want, atol=1e-4)


def test_tokens_are_the_patterns(monkeypatch):
    pattern = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
    rng = random.Random(1)
    signs = ["ab", "B", "É", "é", "1", "²", "_", "__", " ", "\n", "!!", "*", "漢", "\u0301", "x", "　"]
    seen: dict[str, int] = {}
    for _ in range(2000):
        t = "".join(rng.choice(signs) for _ in range(rng.randrange(12)))
        tokens, hashes = pattern.findall(t), quality.token_hashes(t).tolist()
        assert len(tokens) == len(hashes)
        assert all(seen.setdefault(a, b) == b for a, b in zip(tokens, hashes, strict=True))
    assert len(set(seen.values())) == len(seen)
    assert [int(h) & 7 for h in quality.token_hashes("ab AB Ab aB 12 !? _")] == [0, 1, 2, 3, 4, 5, 5]


def test_quality_of_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, None, 0), (None, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for table in (labels, none):
        got = quality.score_quality(edge, table).collect()
        assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got} == {0.5}
    assert quality.score_quality(empty, labels).count() == 0


# --- language ------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    docs = documents(spark, SF)
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    true = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [i for i in true if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    assert sum(got[i]["lang_pred"] == true[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    hidden = docs.withColumn("lang", F.when(quality.held_out(F.col("doc_id"), 4, 2), F.lit("xx")).otherwise(F.col("lang")))
    again = {r["doc_id"]: r["lang_pred"] for r in language.identify(hidden).collect()}
    assert again == {i: r["lang_pred"] for i, r in got.items()}


def test_mixture_proportions():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.full(300, 0.1), size=4) + 1e-6
    p /= p.sum(axis=1, keepdims=True)
    cells = np.concatenate([rng.choice(300, 2800, p=p[1] / p[1].sum()), rng.choice(300, 1200, p=p[3] / p[3].sum())])
    share, score = language.infer(cells, np.log(p))
    assert share[0] == share[2] == 0 and share[1] == pytest.approx(0.7, abs=0.05) and score == share[1]
    alone, _ = language.infer(cells[:2800], np.log(p))
    assert alone.tolist() == [0, 1, 0, 0]


def test_trigrams_are_those_of_letters_at_little_cost():
    def plain(text):
        words, word = [], ""
        for c in (text or "").lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                words, word = [*words, word], ""
        return [ord(c) for c in f" {' '.join(words)} "] if words else []

    rng = random.Random(7)
    pool = [*"aAbZ .,_-019²½①ÄßİéЖ中\n\t", "\u0301", "\ud800", "\U0001d7d8", "\U00010400", "\U00020000"]
    texts = [None, "", "a", " a", "a ", *("".join(rng.choices(pool, k=rng.randrange(14))) for _ in range(500))]
    for text in texts:
        c = np.array(plain(text), dtype=np.uint64)
        want = mix((c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]) & np.uint64(language.CELLS - 1) if len(c) else c
        assert language.trigrams(text).tolist() == want.tolist(), text

    def seconds(fn):
        took = []
        for _ in range(5):
            began = time.process_time()
            fn()
            took.append(time.process_time() - began)
        return min(took)

    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(5000))
    assert seconds(lambda: language.trigrams(text)) < 15 * seconds(lambda: re.findall(r"\w+", text.lower()))


def test_language_of_edge_rows(edge, empty):
    got = defaultdict(list)
    for r in language.identify(edge).collect():
        got[r["doc_id"]].append(r["lang_pred"])
    assert got[1] == got[2] == got[3] == ["und"] and Counter(got[None])["und"] == 1
    assert sum(map(len, got.values())) == 11
    assert language.identify(empty).count() == 0
    assert {r["lang_pred"] for r in language.identify(edge.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- personal data -------------------------------------------------------------

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            ok = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits, x=double: 13 <= len(d) <= 19 and sum(v - 9 * (v > 9) for v in x) % 10 == 0,
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]
            if ok():
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_the_contracts():
    rng = random.Random(10)
    signs = ["a", "b.c", "@", "@", ".com", ".", "-", " ", "1", "22", "255", "256", "4111", "4111 1111 1111 1111", "+", "+1 (988) 555-2485", "(", ")", "%", "é", "10.0.0.1", "1.2.3.4.5.6.7.8", "007"]
    for _ in range(4000):
        t = "".join(rng.choice(signs) for _ in range(rng.randrange(14)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == plain_base(t), t


def test_personal_data_of_documents(spark):
    docs = documents(spark, SF)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in pii.find_pii(docs).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        base = plain_base(t)
        said = [f"{k}:{a}:{b}" for k, a, b in base]
        n = Counter(k for k, _, _ in base)
        r = got[i]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(n[k] for k in pii.KINDS)
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r["spans"].split(",")) | ({""} if not said else set())
    assert sum(r["n_added"] for r in got.values()) <= 0.01 * len(got)


def test_weak_supervision_adds_cued_spans(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        n = f"{rng.randrange(200, 999)}-555-{rng.randrange(1000, 9999)}"
        rows.append((i, f"some words call me at phone {n} or so" if i % 2 else f"some words phone +1 ({n[:3]}) 555-{n[-4:]} or so", "en", "s", 0))
    got = {r["doc_id"]: r for r in pii.find_pii(stored(spark, rows)).collect()}
    assert all(got[i]["n_phone"] == (i + 1) % 2 for i in got)
    assert sum(got[i]["n_added"] for i in got if i % 2) >= 140


def test_personal_data_of_edge_rows(edge, empty):
    got = pii.find_pii(edge).collect()
    assert len(got) == 11
    by = {r["doc_id"]: r for r in got}
    text = next(r["text"] for r in edge.collect() if r["doc_id"] == 8)  # offsets are code points
    assert by[8]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in plain_base(text)) != "" == by[1]["spans"]
    assert by[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(empty).count() == 0


# --- mixing --------------------------------------------------------------------


def plain_mix(rows, budget, seed_order, max_epochs, weigh):
    """Leaves by tree, budgets by repeated filling, prefixes by sorting."""
    leaves = defaultdict(list)
    for i, path, n in rows:
        leaves[path].append((i, n))
    supply = {p: sum(n for _, n in x) for p, x in leaves.items()}

    def fill(total, names, limit, w):
        give = dict.fromkeys(names, 0.0)
        left, active = float(min(total, sum(limit.values()))), set(names)
        while active and left > 1e-9:
            unit = left / sum(w[c] for c in active)
            left = 0.0
            for c in sorted(active):
                give[c] += unit * w[c]
                if give[c] >= limit[c] - 1e-9:
                    left += give[c] - limit[c]
                    give[c] = limit[c]
                    active.discard(c)
        return give

    out = {}

    def down(prefix, total):
        below = sorted({p[: len(prefix) + 1] for p in supply if p[: len(prefix)] == prefix})
        limit = {c: max_epochs * sum(n for p, n in supply.items() if p[: len(c)] == c) for c in below}
        give = fill(total, below, limit, {c: weigh(c) for c in below})
        for c in below:
            if c in supply:
                out[c] = give[c]
            else:
                down(c, give[c])

    down((), budget)
    return out


@pytest.mark.parametrize("part", [0.2, 1.0, 9.0])
def test_budgets_follow_repeated_filling(part):
    rng = random.Random(int(part * 10))
    leaves = {(f"d{d}", la, f"s{s}"): rng.randrange(1, 5000) for d in range(4) for la in ("en", "de") for s in range(rng.randrange(1, 5))}
    budget = int(part * sum(leaves.values()))
    rows = [(k, p, n) for k, (p, n) in enumerate(leaves.items())]
    want = plain_mix(rows, budget, None, 4, mixing.weight)
    got = mixing.budgets(leaves, budget, 4)
    assert sum(got.values()) == min(budget, 4 * sum(leaves.values()))
    assert all(abs(got[p] - want[p]) <= 6 for p in leaves)


def test_selection_is_the_longest_prefix_of_each_epochs_order(spark):
    docs = documents(spark, SF_SMALL)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text", "source", "lang", mixing.domain_of_source().alias("domain")).collect()
    n = {r["rid"]: len((r["text"] or "").split()) for r in rows}
    leaf = {r["rid"]: (r["domain"], r["lang"], r["source"]) for r in rows}
    supply = Counter()
    for k, p in leaf.items():
        supply[p] += n[k]
    given = mixing.budgets(dict(supply), sum(supply.values()), mixing.MAX_EPOCHS)
    got = Counter((r["mix_rid"], r["mix_epoch"]) for r in mixing.mix(docs).collect())
    assert max(got.values()) == 1
    hashes = {(r["rid"], e): r[f"h{e}"] for r in docs.select(F.monotonically_increasing_id().alias("rid"), *[F.xxhash64(F.lit(8), F.lit(e), F.monotonically_increasing_id()).alias(f"h{e}") for e in range(5)]).collect() for e in range(5)}
    want = set()
    for p, total in supply.items():
        own = [k for k in leaf if leaf[k] == p]
        whole, rest = divmod(given[p], total) if total else (1, 0)
        want |= {(k, e) for k in own for e in range(whole)}
        used = 0
        for k in sorted(own, key=lambda k: (hashes[k, whole] % 2**64 >> 52, hashes[k, whole], k)):
            used += n[k]
            if used > rest:
                break
            want.add((k, whole))
    assert set(got) == want


def test_mixing_of_edge_rows(edge, empty):
    out = mixing.mix(edge)
    assert out.columns == ["mix_rid", "mix_leaf_", "mix_epoch", *edge.columns] and out.count() > 0
    most = mixing.mix(edge, budget=10**9)
    assert most.count() >= 4 * 8
    assert mixing.mix(empty).count() == 0


def test_loose_emails_are_looked_for_wherever_they_match():
    for at in (" at ", "[at]", " (at) ", "(at)", " [at] "):
        for dot in (".", " dot ", "[dot]", "(dot)", " [dot] ", " (dot) ", ".-"):
            t = f"write to john.doe{at}example{dot}com today"
            assert [t[a:b] for k, a, b in pii.loose_spans(t, []) if k == 0] == [f"john.doe{at}example{dot}com"], t


def test_ips_with_thousands_of_digits():
    for head in ("0" * 5000, "1" * 5000, "0" * 5000 + "7"):
        assert (1 in {k for k, _, _ in pii.base_spans(f"at {head}.1.2.3 now")}) == (head[-1] != "1")


def test_numerals_are_no_letters(spark):
    rows = [(i, t, lang, "s", 0) for i, (t, lang) in enumerate([("the cat and the dog " * 9, "en"), ("der hund und die katze " * 9, "de"), ("½ ② ² Ⅷ 12 _", None), ("½a", None)])]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(stored(spark, rows)).collect()}
    assert got[2] == "und" and got[3] != "und"


def test_tokens_of_long_texts_are_whole(monkeypatch):
    text = " ".join(f"word{i} Längere" for i in range(20_000)) + "x" * 9000 + " end"
    want = quality.token_hashes(text)
    monkeypatch.setattr(quality, "BLOCK_CHARS", 4096)
    assert (quality.token_hashes(text) == want).all()


# --- pipeline ------------------------------------------------------------------


def test_pipeline_stages_keep_and_drop_what_they_should(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = documents(spark, SF_SMALL)
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "mixing", "packing"]
    seen = {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        seen[name], docs = docs, spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == seen["quality"].columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    after = {r["doc_id"] for r in seen["lines"].collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in after for i in good) >= 0.97 * len(good)
    kept = [r["doc_id"] for r in seen["mixing"].collect()]
    assert len(kept) == len(set(kept)) > 0
    drawn = seen["packing"].count()
    assert sum(r["start"] == 0 for r in docs.collect()) == drawn


def test_pipeline_of_an_empty_table(spark, empty):
    pipeline = pytest.importorskip("corpus_pipeline")
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
