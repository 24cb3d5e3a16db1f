import hashlib
import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repo_pulse.llm import bloom_lm, pii, posting_lists, quality_knn
from repo_pulse.llm.frequent import frequent
from tests.llm.helpers import ODD, SCHEMA, clusters, documents, prose, words

# The patterns as the contract spells them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def digits(text):
    return re.sub("[^0-9]", "", text)


def checked(kind, match):
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        own = [int(d) for d in digits(match)][::-1]
        doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(own)]
        return 13 <= len(own) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits(match)) <= 15


def spans(text):
    return [
        (kind, *m.span())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if checked(kind, m[0])
    ]


def test_base_spans_against_the_patterns():
    pick = random.Random(9)
    for _ in range(20_000):
        text = "".join(pick.choice("a1.@+- ()9%_2\n5é4") for _ in range(pick.randint(0, 45)))
        assert pii.base_spans(text) == spans(text)


HELD = "Éa x@y.org, call +1 (040) 555-0631 now 4111 1111 1111 1111 from 10.0.0.255 or 1.2.3.4.5.6.7.8"


def test_personal_data_and_terms_that_disclose_it(spark):
    rows = [*ODD, (50, HELD), (51, "a@b nothing 999.1.1.1 here 4111111111111112 +12"), (52, "1" * 3000)]
    rows += [(100 + i, f"{prose(i, 9)} Zorblat wrote to zz@top.example {prose(90 + i, 9)}") for i in range(5)]
    rows += [(200 + i, f"{prose(i, 50)} common words") for i in range(40)]
    docs = documents(spark, rows)
    got = [r.asDict() for r in pii.report(docs).collect()]
    assert len(got) == len(rows)
    texts = {d: t for d, t in rows}
    for r in got:
        own = spans(texts[r["doc_id"]]) if r["doc_id"] is not None else []
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in own) for k in PATTERNS]
        assert r["spans"].startswith(told)
    hidden = {r["doc_id"]: r["spans"] for r in got if r["n_terms"]}
    assert set(hidden) == {100 + i for i in range(5)}
    for doc_id, told in hidden.items():
        kind, start, end = next(s for s in told.split(",") if s.startswith("removed")).split(":")
        assert texts[doc_id][int(start) : int(end)] in ("Zorblat", "wrote")
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns
    after = clean.toDF(*[f"c{i}" for i in range(8)])
    found = {r[0]: r[1] for r in after.collect()}
    assert found[50] == (
        "Éa [EMAIL], call [PHONE] now [CARD] from [IP] or [IP].[IP]"
    )
    assert "Zorblat" not in found[101] and "[EMAIL]" in found[101]
    assert all(found[200 + i] == texts[200 + i] for i in range(40))
    assert found[2] is None and found[3] == ""


def test_copies_of_one_context_disclose_nothing(spark):
    rows = [(i, f"Zorblat wrote to zz@top.example {prose(1, 30)}") for i in range(30)]
    rows += [(100 + i, prose(i, 30)) for i in range(30)]
    got = pii.report(documents(spark, rows))
    assert got.agg(F.sum("n_terms")).first()[0] == 0 and got.filter("n_email = 1").count() == 30


def test_any_word_of_a_document_may_disclose(spark):
    """Names with marks or digits and of two letters, and a name far from every mention."""
    near = ("O'Brien", "Jean-Luc", "acme2", "Xu")
    rows = [
        (i, f"Quillon {prose(i, 25)} {' '.join(near)} zz@top.example {prose(90 + i, 25)}")
        for i in range(6)
    ]
    rows += [(100 + i, f"{prose(200 + i, 50)} common words") for i in range(60)]
    texts = dict(rows)
    for r in pii.report(documents(spark, rows)).filter("n_email = 1").collect():
        told = [s.split(":") for s in r["spans"].split(",")]
        hidden = {texts[r["doc_id"]][int(a) : int(b)] for kind, a, b in told if kind in pii.TERM_KINDS}
        assert hidden >= {*near, "Quillon"}
    after = pii.sanitised(documents(spark, rows))
    for doc_id, text in after.toDF(*[f"c{i}" for i in range(8)]).select("c0", "c1").collect():
        assert doc_id >= 100 or not any(name in text for name in (*near, "Quillon"))


def junk(seed):
    pick = random.Random(seed)
    kind = seed % 3
    own = [f"w{pick.randrange(300)}" for _ in range(60)]
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in own)
    return " ".join([own[0]] * 60) if kind == 1 else " ".join(w + "%%%" for w in own)


def test_quality_by_neighbours(spark):
    rows = [(i, junk(i) if i % 4 == 0 else prose(i, 60).capitalize()) for i in range(400)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(400)] + [(1, 1, 1), (2, None, 0), (None, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = documents(spark, [*ODD, *rows[20:]])
    got = quality_knn.score(docs, labels).collect()
    assert len(got) == len(ODD) + 380
    for r in got:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and r["doc_id"] >= 20]
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 4 != 0) for r in held)
    assert len(held) > 50 and right >= 0.95 * len(held)
    empty = {r["score"] for r in got if r["doc_id"] in (2, 3, 4)}
    assert len(empty) == 1
    none = quality_knn.score(docs, labels.limit(0)).agg(F.min("score"), F.max("score")).first()
    assert tuple(none) == (0.5, 0.5)


def test_held_out_labels_are_not_learnt(spark):
    docs = documents(spark, [(i, prose(i, 30)) for i in range(200)])
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)]
    labels = [(i, int(not held[i]), 0) for i in range(200)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert quality_knn.score(docs, labels).filter("score < 1").count() == 0


def test_language_model(spark, monkeypatch):
    rows = [*ODD, *((100 + i, prose(i % 60, 40)) for i in range(150))]
    tokens = [[*words(t), None] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(t for own, h in zip(tokens, held, strict=True) if not h for t in own)
    total, kinds = sum(counts.values()), len(counts)
    for exact in (bloom_lm.EXACT_WORDS, 30):
        monkeypatch.setattr(bloom_lm, "EXACT_WORDS", exact)
        got = bloom_lm.score(documents(spark, rows)).collect()
        told = Counter(
            (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
            for r in got
        )
        want = Counter()
        for (doc_id, _), own, h in zip(rows, tokens, held, strict=True):
            base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in own)
            known = sum(counts[t] > 0 for t in own)
            want[doc_id, h, len(own), known, total, round(base, 6)] += 1
        assert told == want
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
        # Texts that are repeated are likelier under pairs of words than word by word.
        new = [r for r in got if r["held_out"] and r["doc_id"] >= 100]
        assert sum(r["score"] for r in new) > sum(r["base_score"] for r in new)


@pytest.mark.parametrize("power", [0, 900, -900])
def test_posting_lists_of_any_size(spark, power):
    """Squares of such components overflow or vanish; a repeated query asks with both vectors."""
    vectors = np.array(clusters(11))
    rows = [(i, [float(x) for x in np.ldexp(v, power)]) for i, v in enumerate(vectors)]
    rows += [(100, rows[130][1]), (100, rows[130][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = posting_lists.search(frame, every=50, neighbours=10).collect()
    assert len({(r["query_id"], r["vec_id"]) for r in got}) == len(got)
    exact = {}
    for q in range(0, len(vectors), 50):
        for own in [q] + [130] * (q == 100):
            for i, v in enumerate([*vectors, vectors[130]]):
                name = 100 if i == len(vectors) else i
                d = float(np.ldexp(np.sqrt(((v - vectors[own]) ** 2).sum()), power))
                exact[q, name] = min(d, exact.get((q, name), np.inf))
    assert all(r["score"] == exact[r["query_id"], r["vec_id"]] for r in got)
    hits = 0
    for q in range(0, len(vectors), 50):
        own = {r["vec_id"] for r in got if r["query_id"] == q}
        want = sorted((d, i) for (a, i), d in exact.items() if a == q and i != q)[:10]
        hits += len(own & {i for _, i in want})
    assert hits >= 0.9 * 10 * len(range(0, len(vectors), 50))


def language(seed, texts=300, kinds=500):
    """Words of unequal frequency, each followed by some more than by others."""
    pick = np.random.default_rng(seed)
    share = 1 / np.arange(1, kinds + 1)
    follow = pick.integers(0, kinds, (kinds, 3))
    out = []
    for _ in range(texts):
        own = [int(pick.choice(kinds, p=share / share.sum()))]
        while len(own) < 60:
            if pick.random() < 0.6:
                own.append(int(follow[own[-1], pick.integers(3)]))
            else:
                own.append(int(pick.choice(kinds, p=share / share.sum())))
        out.append([f"v{i}" for i in own])
    return out


def spelled_hashes(words):
    return bloom_lm.word_hashes(pa.array([w.encode() for w in words], pa.large_binary()))


def test_probabilities_sum_to_one(spark):
    texts = language(1)
    frame = spark.createDataFrame([(" ".join(t),) for t in texts], "text string")
    for limit in (400_000, 100):
        bound = bloom_lm.UNIGRAMS
        try:
            bloom_lm.UNIGRAMS = limit
            model = bloom_lm.fit(frame, bloom_lm.word_counts(frame, lower=True))
        finally:
            bloom_lm.UNIGRAMS = bound
        kinds = sorted({w for t in texts for w in t})
        after = np.append(spelled_hashes([*kinds, "never"]), np.uint64(bloom_lm.END))
        assert len(np.unique(after)) == len(after)
        for before in [np.uint64(bloom_lm.START), *spelled_hashes([*kinds[::10], "unseen"])]:
            told = 10 ** model.log10(np.full(len(after), before), after)
            assert told.min() > 0 and abs(told.sum() - 1) < 1e-3


def test_score_is_that_of_a_plain_model(spark):
    """The same formula over exact counts; quantised counts move a token's score little."""
    texts = language(2)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    one, two = Counter(), Counter()
    for i, t in enumerate(texts):
        if i not in held:
            one.update([*t, "</s>"])
            two.update(zip(["<s>", *t], [*t, "</s>"], strict=True))
    two = {pair: n for pair, n in two.items() if n > 1}
    mass = Counter()
    for (h, _), n in two.items():
        mass[h] += n - 0.5
    whole = sum(one.values()) + 0.1 * (len(one) + 1)
    got = {r["doc_id"]: r for r in bloom_lm.score(documents(spark, rows)).collect()}
    for i, t in enumerate(texts):
        score = 0.0
        for h, w in zip(["<s>", *t], [*t, "</s>"], strict=True):
            n = one["</s>"] if h == "<s>" else one[h]
            n = max(n, mass[h] + 0.5)
            seen = max(two.get((h, w), 0) - 0.5, 0)
            score += math.log10(seen / n + (1 - mass[h] / n) * (one[w] + 0.1) / whole)
        assert abs(got[i]["score"] - score) < 0.03 * (len(t) + 1)


@pytest.mark.parametrize("unigrams, bigrams", [(400_000, 60), (40, 2_000_000), (40, 60), (0, 0)])
def test_score_is_the_same_however_little_the_filter_holds(spark, monkeypatch, unigrams, bigrams):
    texts = language(4)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000, "never seen v1 v2 words"), (1001, None), (1002, ""), (1003, "v3 never v3 v3 v499 v498")]
    docs = documents(spark, rows)

    def scores():
        got = bloom_lm.score(docs).collect()
        return {r["doc_id"]: (r["n_tokens"], r["n_known"], round(r["base_score"], 6), r["score"]) for r in got}

    whole = scores()
    monkeypatch.setattr(bloom_lm, "UNIGRAMS", unigrams)
    monkeypatch.setattr(bloom_lm, "BIGRAMS", bigrams)
    monkeypatch.setattr(bloom_lm, "SHARD_PAIRS", 300)
    got = scores()
    assert set(got) == set(whole)
    for doc_id, (*others, score) in got.items():
        assert others == list(whole[doc_id][:3])
        assert abs(score - whole[doc_id][3]) < 1e-3 * others[0]


def test_numbers_come_back_from_the_filter():
    pick = np.random.default_rng(8)
    keys = pick.integers(1, 1 << 62, 3000).astype(np.uint64)
    numbers = pick.integers(1, 1 << pick.integers(1, 40, 3000))
    entries = sum(d.sum() for d in bloom_lm.digits_of(numbers))
    bloom = bloom_lm.LogFrequencyBloom(int(entries))
    bloom.add_numbers(keys, numbers)
    assert (bloom.numbers(keys) == numbers).mean() > 0.999
    assert (bloom.numbers(keys + np.uint64(1)) > 0).mean() < 0.001


def test_a_published_filter_is_mapped_not_sent(spark):
    """What workers unpickle holds no bits; what they map gives the same levels."""
    pick = np.random.default_rng(5)
    keys = pick.integers(1, 1 << 62, 5000).astype(np.uint64)
    levels = pick.integers(1, 20, 5000)
    bloom = bloom_lm.LogFrequencyBloom(int(levels.sum()))
    bloom.add(keys, levels)
    sent = pickle.dumps(bloom.published(spark))
    assert len(sent) < 1000
    got = pickle.loads(sent)
    assert isinstance(got.bits, np.memmap) and (got.levels(keys, 40) == bloom.levels(keys, 40)).all()


def test_filter_never_loses_a_level():
    pick = np.random.default_rng(3)
    keys = pick.integers(1, 1 << 62, 5000).astype(np.uint64)
    levels = pick.integers(1, 20, 5000)
    bloom = bloom_lm.LogFrequencyBloom(int(levels.sum()))
    bloom.add(keys, levels)
    got = bloom.levels(keys, 40)
    assert (got >= levels).all() and (got == levels).mean() > 0.99
    others = pick.integers(1, 1 << 62, 5000).astype(np.uint64) | np.uint64(1 << 62)
    assert (bloom.levels(others, 40) > 0).mean() < 0.02


def test_frequent_keeps_within_its_limit(spark):
    counts = spark.createDataFrame([(f"w{i}", 1 + i // 10) for i in range(500)], "word string, n bigint")
    for limit in (0, 5, 37, 499, 500):
        got = sorted(r["n"] for r in frequent(counts, limit).collect())
        assert len(got) <= limit
        assert got == sorted((1 + i // 10 for i in range(500)), reverse=True)[: len(got)][::-1]
    assert frequent(counts, 500).count() == 500


def nearest(vectors, ids, query, k):
    away = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
    others = [i for i in range(len(ids)) if ids[i] != ids[query]]
    return sorted((away[i], ids[i]) for i in others)[:k]


def test_posting_lists(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "PART_ROWS", 40)
    vectors = np.array(clusters(7))
    ids = list(range(len(vectors)))
    rows = [(i, [float(x) for x in v], "x", 0) for i, v in zip(ids, vectors, strict=True)]
    odd = [(1000, None, "x", 0), (1010, [0.0] * 16, "x", 0), (1020, [1.0], "x", 0)]
    odd += [(1030, [float("nan")] * 16, "x", 0), (None, rows[0][1], "x", 0), (1040, [None] * 16, "x", 0)]
    frame = spark.createDataFrame(
        [*rows, *odd], "vec_id bigint, embedding array<double>, list string, SCORE int"
    )
    got = posting_lists.search(frame, every=10, neighbours=10).collect()
    answers = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        answers.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(answers[r["query_id"]])
    assert set(answers) == set(range(0, len(ids), 10))
    hits = 0
    for q, own in answers.items():
        want = nearest(vectors, ids, q, 10)
        hits += len({i for _, i in own} & {i for _, i in want})
        assert own == sorted(own)
        exact = {i: d for d, i in nearest(vectors, ids, q, len(ids))}
        assert all(d == exact[i] for d, i in own)
    assert hits >= 0.95 * 10 * len(answers)
    few = frame.filter("vec_id < 4")
    assert posting_lists.search(few, every=1, neighbours=10).count() == 12


def test_queries_are_copied_a_few_at_a_time(monkeypatch):
    """A query that reads every list goes once to each part of a shelf, in batches of bounded size."""
    monkeypatch.setattr(posting_lists, "PART_VALUES", 4000)
    pick = np.random.default_rng(2)
    index = posting_lists.Index.over(pick.standard_normal((64, 8)), 1000.0)
    shelf, parts = posting_lists.shelved(np.array([10] * 63 + [95]), 40)
    assert shelf.tolist() == [i // 4 for i in range(63)] + [16] and parts.tolist() == [1] * 16 + [3]
    x = pick.standard_normal((300, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(x.tolist())], ["vec_id", "embedding"])
    got = list(posting_lists.copies(batch, index, shelf, parts, 8, 8.0))
    assert max(b.num_rows for b in got) * 8 <= 4000
    rows = pa.Table.from_batches(got).to_pylist()
    assert len(rows) == 300 * 19
    for r in rows:
        assert r["embedding"] == x[r["vec_id"]].tolist()
        assert r["lists"] == [i for i in range(64) if shelf[i] == r["shelf"]]
    assert len({(r["vec_id"], r["shelf"], r["v"]) for r in rows}) == len(rows)


def test_posting_lists_on_shelves_of_many_parts(spark, monkeypatch):
    """However shelves, their parts and the parts of queries are cut, the answers are the same."""
    vectors = np.array(clusters(13))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    told = []
    for part_rows, part_values, shelves in ((32_768, 1 << 21, 64), (25, 1 << 21, 64), (32_768, 160, 2), (32_768, 1 << 21, 1)):
        monkeypatch.setattr(posting_lists, "PART_ROWS", part_rows)
        monkeypatch.setattr(posting_lists, "PART_VALUES", part_values)
        monkeypatch.setattr(posting_lists, "SHELVES", shelves)
        got = posting_lists.search(frame, every=5, neighbours=10).collect()
        told.append(sorted(map(tuple, got)))
    assert len(told[0]) == 10 * len(range(0, len(vectors), 5))
    assert told[1:] == told[:1] * 3


def test_walk_finds_what_a_scan_finds():
    pick = np.random.default_rng(1)
    index = posting_lists.Index.over(pick.standard_normal((256, 24)), 1.0)
    found = scanned = 0
    for query in pick.standard_normal((100, 24)):
        away = np.sqrt(((index.centroids - query) ** 2).sum(axis=1))
        near = set(np.flatnonzero(away <= 1.15 * away.min()).tolist())
        found += len(near & set(index.walk(query, 1.15).tolist()))
        scanned += len(near)
    assert found >= 0.97 * scanned


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert pii.report(docs).count() == 0 and pii.sanitised(docs).count() == 0
    assert quality_knn.score(docs, labels).count() == 0
    assert bloom_lm.score(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert posting_lists.search(vectors, 100, 10).count() == 0
