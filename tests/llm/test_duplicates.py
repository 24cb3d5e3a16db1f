import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from repo_pulse.llm import compact_windows, projection_forest, simhash
from repo_pulse.llm.components import components
from repo_pulse.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import ODD, SCHEMA, clusters, documents, merged, prose, words


def fingerprint(text):
    own = [w.encode() for w in words(text)]
    shingles = [b" ".join(own[i : i + 3]) for i in range(max(len(own) - 2, 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def near_copies(count, seed=3):
    base, pick = prose(seed, 400).split(), random.Random(seed)
    for _ in range(count):
        own = list(base)
        own[pick.randrange(len(own))] = "changed"
        yield " ".join(own)


def test_simhash_against_all_pairs(spark):
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(near_copies(60)))]
    rows += [(200 + i, prose(i, 20)) for i in range(40)] + [(300, "two words"), (301, "TWO words")]
    got = simhash.near_duplicates(documents(spark, rows), 3, 2).collect()
    prints = [fingerprint(t) for _, t in rows]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    group = merged(range(len(rows)), pairs)
    want = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in group if group[j] == group[i] and rows[j][0] is not None]
        want.append((doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    kept = simhash.one_of_each(documents(spark, rows), 3, 2)
    assert kept.columns == documents(spark, rows).columns
    ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None)
    assert ids == sorted({c for _, _, c in want if c is not None})


def test_simhash_grid_finds_every_near_pair(spark):
    pick = random.Random(5)
    values = [pick.getrandbits(64) for _ in range(300)]
    for v in list(values[:150]):
        values.append(v ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)))
    values += [0, (1 << 64) - 1, (1 << 64) - 2, 3, 7]
    values = list(dict.fromkeys(values))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = components(simhash.links(spark.createDataFrame(signed, "fingerprint bigint"), 2))
    got = {r["node"]: r["root"] for r in found.collect()}
    pairs = [
        (a, b)
        for a in range(len(values))
        for b in range(a)
        if (values[a] ^ values[b]).bit_count() <= 2
    ]
    group = merged(range(len(values)), pairs)
    for a in range(len(values)):
        for b in range(a):
            same = got.get(signed[a][0], a) == got.get(signed[b][0], b + 0.5)
            assert same == (group[a] == group[b])


def test_simhash_refuses_odd_distances(spark):
    with pytest.raises(ValueError, match="even"):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint bigint"), 3)


def test_components(spark):
    pick = random.Random(1)
    chain = [(i, i + 1) for i in range(1000, 1100)]
    hub = [(0, i) for i in range(1, 200)]
    more = [(pick.randrange(2000, 2300), pick.randrange(2000, 2300)) for _ in range(200)]
    edges = chain + hub + more + [(5000, 5000), (7, 7), (7, 0)]
    pick.shuffle(edges)
    frame = spark.createDataFrame([*edges, (None, 3), (4, None)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    proper = [(a, b) for a, b in edges if a != b]
    assert got == merged({n for e in proper for n in e}, proper)


@pytest.mark.parametrize("leaf_rows", [64, 5000])
def test_forest_against_all_pairs(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(projection_forest.fit, "__defaults__", (8, leaf_rows))
    vectors = clusters(2)
    rows = [(i, [float(x) for x in v], 1, "x") for i, v in enumerate(vectors)]
    rows += [(900, None, 1, "x"), (901, [0.0] * 16, 1, "x"), (902, [float("nan")] * 16, 1, "x")]
    rows += [(903, [None] + [1.0] * 15, 1, "x"), (904, [float("inf")] * 16, 1, "x"), (905, [], 1, "x")]
    rows += [(906, [1.0, 2.0], 1, "x"), (None, rows[0][1], 1, "x"), (3, rows[3][1], 1, "x")]
    frame = spark.createDataFrame(
        rows, "vec_id bigint, embedding array<double>, copies int, NODE string"
    )
    got = projection_forest.near_duplicates(frame, 0.9).collect()
    x = np.array([*vectors, vectors[3]])
    names = [*range(len(vectors)), 3]
    linked = x @ x.T >= 0.9
    group = merged(range(len(x)), [(int(a), int(b)) for a, b in np.argwhere(linked) if a > b])
    want = []
    for i, name in enumerate(names):
        component = min(names[j] for j in group if group[j] == group[i])
        want.append((name, int(linked[i].sum()) - 1, component, name == component))
    want += [(i, 0, i, True) for i in range(900, 907)] + [(None, 0, None, False)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("part_values", [1 << 19, 16 * 200])
def test_forest_keeps_a_group_of_near_copies_whole(spark, monkeypatch, part_values):
    """A third of the rows are near copies of one vector: many leaves, or parts, large."""
    monkeypatch.setattr(projection_forest.fit, "__defaults__", (8, 32))
    monkeypatch.setattr(projection_forest, "PART_VALUES", part_values)
    pick = np.random.default_rng(8)
    one = pick.standard_normal(16)
    x = [*pick.standard_normal((2400, 16)), *(one + 0.22 * pick.standard_normal((1200, 16)))]
    x = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in projection_forest.near_duplicates(frame, 0.9).collect()}
    linked = x @ x.T >= 0.9
    links = linked.sum(axis=1) - 1
    assert links[2400:].mean() > 600
    told = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (told <= links).all() and told.sum() >= 0.9999 * links.sum()
    group = merged(range(len(x)), [(int(a), int(b)) for a, b in np.argwhere(linked) if a > b])
    assert sum(got[i]["component_id"] != group[i] for i in group) <= 2


def test_forest_equals_its_sql(spark, tmp_path):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(clusters(11))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    frame.write.parquet(str(tmp_path / "embeddings.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    answer = connection.execute(ORACLES["op2_projection_forest"])
    names = [c[0] for c in answer.description]
    got = QUERIES["op2_projection_forest"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(answer.fetchall())


def test_windows_are_those_of_the_definition():
    pick = np.random.default_rng(4)
    for size in (1, 4, 5, 6, 40):
        for top in (3, 1000):
            own = pick.integers(1, top, size).astype(np.uint64)
            values = np.concatenate([[0], own, [0]]).astype(np.uint64)
            got = set(zip(*(a.tolist() for a in compact_windows.compact_windows(values, 5)), strict=True))
            want = set()

            def split(low, high, own=own, want=want):
                if high - low < 5:
                    return
                centre = low + int(own[low:high].argmin())
                want.add((low + 1, centre + 1, high))
                split(low, centre)
                split(centre + 1, high)

            split(0, size)
            assert got == want


def test_repeated_passages(spark):
    shared, near = prose(900, 60, 10**6), prose(901, 80, 10**6).split()
    short = prose(902, 49, 10**6)
    changed = [*near[:40], "other", *near[41:]]
    rows = [
        (1, f"{prose(1, 90)} {shared.upper()} {prose(2, 30)}"),
        (2, f"{prose(3, 20)}\n\n{shared}  {prose(4, 200)}"),
        (3, f"{prose(5, 70)} {' '.join(near)}"),
        (4, f"{' '.join(changed)} {prose(6, 70)}"),
        (5, f"{short} {prose(7, 70)}"),
        (6, f"{prose(8, 70)} {short}"),
        (7, shared),
        *((100 + i, f"{prose(50 + i, 40)} {shared}") for i in range(20)),
    ]
    odd = [(d and d + 5000, t) for d, t in ODD]
    docs = documents(spark, [*odd, *rows])
    got = {r["doc_id"]: r for r in compact_windows.report(docs).collect()}
    assert got[1]["n_passages"] == 0 and got[1]["component_id"] == 1
    assert (got[2]["component_id"], got[2]["spans"]) == (1, "20:80")
    assert (got[4]["component_id"], got[4]["n_links"]) == (3, 1)
    start, end = map(int, got[4]["spans"].split(":"))
    assert start <= 1 and end >= 79
    assert all(got[i]["spans"] == "" and got[i]["component_id"] == i for i in (5, 6, 5008, 5010))
    assert all(got[100 + i]["spans"] == "40:100" for i in range(20))
    kept = compact_windows.without_repeats(docs)
    assert kept.columns == docs.columns
    texts = {r[0]: r[1] for r in kept.toDF(*[f"c{i}" for i in range(8)]).collect()}
    assert 7 not in texts and texts[1] == rows[0][1] and texts[5] == rows[4][1]
    assert texts[2] == f"{prose(3, 20)}\n\n{prose(4, 200)}"
    assert sum(shared in (t or "").lower() for t in texts.values()) == 1


def test_passages_whose_shingles_earlier_documents_own(spark):
    """Parts of under 50 words, which hold nearly every shingle of a passage, stand in documents
    before the two that share the whole passage."""
    rows = []
    for n in range(60):
        passage = prose(5000 + n, 64, 10**6).split()
        for i, part in enumerate((passage[:36], passage[28:])):
            rows.append((100 * n + i, f"{' '.join(part)} {prose(n * 70 + i, 16, 10**6)}"))
        for i in (50, 51):
            around = prose(n * 90 + i, 40, 10**6), prose(n * 110 + i, 40, 10**6)
            rows.append((100 * n + i, f"{around[0]} {' '.join(passage)} {around[1]}"))
    got = {r["doc_id"]: r for r in compact_windows.report(documents(spark, rows)).collect()}
    found = sum(got[100 * n + 51]["spans"] == "40:104" for n in range(60))
    assert found >= 59, found
    assert all(got[100 * n + 50]["spans"] == "" for n in range(60))


def test_passages_of_documents_with_others_between(spark, monkeypatch):
    """Neither the first document with a shingle of a passage nor the one before holds it whole."""
    rows = []
    for n in range(40):
        passage = prose(7000 + n, 64, 10**6).split()
        for i in range(10):
            part = passage[:48] if i % 2 else passage[16:]
            around = prose(n * 70 + i, 30, 10**6), prose(n * 80 + i, 30, 10**6)
            rows.append((100 * n + 10 * i, f"{around[0]} {' '.join(part)} {around[1]}"))
        for i in (25, 65):
            around = prose(n * 90 + i, 40, 10**6), prose(n * 110 + i, 40, 10**6)
            rows.append((100 * n + i, f"{around[0]} {' '.join(passage)} {around[1]}"))
    for block in (1000, 3):
        monkeypatch.setattr(compact_windows, "BLOCK", block)
        got = {r["doc_id"]: r for r in compact_windows.report(documents(spark, rows)).collect()}
        found = sum(
            (got[100 * n + 65]["spans"], got[100 * n + 65]["component_id"]) == ("40:104", 100 * n + 25)
            for n in range(40)
        )
        assert found >= 39, found
        assert all(got[d]["spans"] == "" for d, _ in rows if d % 100 != 65)


@pytest.mark.parametrize("between", [6, 20])
def test_passages_that_go_on_behind_one_found(spark, between):
    """A few words behind a passage found in many documents stand, with its end, in one of them only."""
    rows, passages = [], 30
    for n in range(passages):
        passage = prose(9000 + n, 60, 10**6).split()
        for i in range(between + 3):
            part = passage[8:] if i == 1 else passage if i == between + 2 else passage[:54]
            around = prose(n * 70 + 13 * i, 40, 10**6), prose(10**5 + n * 80 + 17 * i, 40, 10**6)
            rows.append((100 * n + i, f"{around[0]} {' '.join(part)} {around[1]}"))
    got = {r["doc_id"]: r for r in compact_windows.report(documents(spark, rows)).collect()}
    last = [got[100 * n + between + 2] for n in range(passages)]
    found = sum(r["spans"] == "40:100" for r in last)
    assert found >= passages - 1, (found, [r["spans"] for r in last])
    assert {r["component_id"] for r in last} == {100 * n for n in range(passages)}


def plainly_agreeing(a, b):
    """Passages of b that a holds too, shingle by shingle, as the operator defines them."""
    n, width = compact_windows.SHINGLE_WORDS, compact_windows.MIN_WORDS - 4
    of_a = [tuple(a[i : i + n]) for i in range(len(a) - n + 1)]
    of_b = [tuple(b[i : i + n]) for i in range(len(b) - n + 1)]
    places = {}
    for i, shingle in enumerate(of_a):
        places.setdefault(shingle, []).append(i)
    stretches = []
    for j, shingle in enumerate(of_b):
        if shingle not in places:
            continue
        options = places[shingle]
        if stretches and j - stretches[-1][-1][1] <= compact_windows.GAP + 1:
            own = stretches[-1]
            start, last = own[-1]
            if len(own) == 1:
                start = compact_windows.closest_start(places[of_b[last]], options, j - last)
            near = min(options, key=lambda place: abs(place - start - j + last))
            if abs(near - start - j + last) <= compact_windows.SHIFT:
                own[-1:] = [(start, last), (near, j)]
                continue
        stretches.append([(options[0], j)])
    found = []
    while stretches:
        own = stretches.pop()
        start, end = own[0][1], own[-1][1] + 1
        if end - start < width or len(own) < compact_windows.SIMILARITY * width:
            continue
        in_a = set(of_a[min(i for i, _ in own) : max(i for i, _ in own) + 1])
        in_b = set(of_b[start:end])
        if len(in_a & in_b) >= compact_windows.SIMILARITY * len(in_a | in_b):
            found.append((start, end + n - 1))
            continue
        gaps = [max(y[1] - x[1], abs(y[0] - x[0])) for x, y in zip(own[:-1], own[1:], strict=True)]
        cut = gaps.index(max(gaps)) + 1
        stretches += [own[:cut], own[cut:]]
    return sorted(found)


def changed(pick, base):
    """The words with some of them replaced, left out, put in or moved."""
    out = list(base)
    for _ in range(pick.choice([0, 0, 1, 3, 10, 40])):
        at, what = pick.randrange(len(out)), pick.randrange(4)
        if what == 0:
            out[at] = f"x{pick.randrange(9)}"
        elif what == 1 and len(out) > 1:
            del out[at]
        elif what == 2:
            out.insert(at, "y")
        else:
            out[at : at + pick.randrange(1, 40)] = [f"z{k}" for k in range(pick.randrange(1, 40))]
    return out


def test_passages_are_followed_as_one_shingle_after_the_other():
    pick = random.Random(3)
    pairs = []
    for _ in range(600):
        vocabulary = pick.choice([1, 2, 5, 40, 10**6])
        base = [f"w{pick.randrange(vocabulary)}" for _ in range(pick.choice([60, 150, 400]))]
        pairs.append((changed(pick, base), changed(pick, base)))
    pairs += [([], base), (base, []), (base[:4], base[:4])]
    columns = (pa.array([" ".join(words) for words in side]) for side in zip(*pairs, strict=True))
    found = 0
    for (a, b), in_a, in_b in zip(pairs, *compact_windows.shingles_of(*columns), strict=True):
        want = plainly_agreeing(a, b)
        assert compact_windows.agreeing(in_a, in_b) == want
        found += len(want)
    assert found > 200


def test_passages_against_all_pairs(spark):
    """Documents of a few common sentences, with whole and changed copies of passages: a third of
    all rows hold the same one."""
    pick = random.Random(17)
    shared = [prose(3000 + i, pick.randrange(50, 120), 10**6).split() for i in range(12)]
    rows = []
    for i in range(150):
        text = prose(4000 + i, pick.randrange(30, 120), 3000 if i % 2 else 10**6).split()
        for passage in (shared[0],) if i % 3 == 0 else pick.sample(shared, pick.randrange(3)):
            own = list(passage)
            if pick.random() < 0.5:
                own[pick.randrange(len(own))] = "other"
            at = pick.randrange(len(text))
            text[at:at] = own
        rows.append((i, " ".join(text)))
    got = {r["doc_id"]: r for r in compact_windows.report(documents(spark, rows)).collect()}
    wanted = held = both = 0
    links = []
    for i, text in rows:
        plain, told = set(), set()
        for j, earlier in rows[:i]:
            spans = plainly_agreeing(words(earlier), words(text))
            links += [(i, j)] * bool(spans)
            for start, end in spans:
                plain |= set(range(start, end))
        for span in filter(None, got[i]["spans"].split(",")):
            told |= set(range(*map(int, span.split(":"))))
        wanted, held, both = wanted + len(plain), held + len(told), both + len(plain & told)
    assert both >= 0.99 * wanted and both >= 0.99 * held, (wanted, held, both)
    group = merged([i for i, _ in rows], links)
    assert sum(got[i]["component_id"] != group[i] for i in group) <= 2


def test_repeats_of_long_and_equal_documents(spark):
    text = prose(77, 3000, 10**6)
    rows = [(i, text) for i in range(30)] + [(40, text + " " + prose(78, 100))]
    got = {r["doc_id"]: r for r in compact_windows.report(documents(spark, rows)).collect()}
    assert {r["component_id"] for r in got.values()} == {0}
    assert all(got[i]["spans"] == "0:3000" for i in range(1, 30))
    assert got[0]["spans"] == "" and got[40]["spans"] == "0:3000"


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs, 3, 2).count() == 0
    assert simhash.one_of_each(docs, 3, 2).count() == 0
    assert compact_windows.report(docs).count() == 0
    assert compact_windows.without_repeats(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert projection_forest.near_duplicates(vectors, 0.9).count() == 0


def test_links_do_not_depend_on_the_size_of_vectors(spark):
    pick = np.random.default_rng(4)
    base = pick.standard_normal((200, 16))
    rows = [v for v in base] + [v + 0.01 * pick.standard_normal(16) for v in base[:50]]
    powers = pick.choice([-1000, -400, 0, 400, 1000], len(rows))
    frame = spark.createDataFrame(
        [(i, [float(x) for x in np.ldexp(v, int(p))]) for i, (v, p) in enumerate(zip(rows, powers, strict=True))],
        "vec_id bigint, embedding array<double>",
    )
    unit = np.array([v / np.linalg.norm(v) for v in rows])
    near = unit @ unit.T >= 0.9
    for r in projection_forest.near_duplicates(frame, 0.9).collect():
        assert r["n_links"] == near[r["vec_id"]].sum() - 1


def test_a_line_of_many_texts_pairs_only_those_with_more_in_common(spark, monkeypatch):
    """Texts that share a line and nothing else never meet; those with a passage around it do."""
    line, rows = prose(1, 30, 10**6), []
    for i in range(60):
        rows.append((i, f"{prose(100 + i, 40, 10**6)} {line} {prose(200 + i, 40, 10**6)}"))
    for i in (25, 55):
        around = prose(10, 20, 10**6), prose(11, 20, 10**6)
        rows[i] = (i, f"{prose(300 + i, 40, 10**6)} {around[0]} {line} {around[1]}")
    met, own = [], compact_windows.narrowed

    def counted(*asked):
        pairs = own(*asked)
        met.extend((r["x"]["doc_id"], r["y"]["doc_id"]) for r in pairs.collect())
        return pairs

    monkeypatch.setattr(compact_windows, "narrowed", counted)
    got = {r["doc_id"]: r for r in compact_windows.report(documents(spark, rows)).collect()}
    assert got[55]["spans"] == "40:110"
    assert all(got[i]["spans"] == "" for i in range(60) if i != 55)
    assert set(met) <= {(25, 55)}


def test_hashes_of_words_depend_on_their_bytes_alone():
    words = ["a", "b", "ab", "a" * 7, "a" * 8, "a" * 9, "a" * 16, "a" * 17, "é", "a\0", "zażółć" * 9]
    words += [f"{'x' * n}{m}" for n in range(30) for m in "ab"]
    rows = [" ".join(words), " ".join(reversed(words)), None, "", "  "]
    cut = [
        compact_windows.words_of(compact_windows.lowered(pa.array([text], pa.string())))
        for text in rows
    ]
    forth, back, *others = [compact_windows.word_hashes(own) for own in cut]
    assert forth.tolist() == back[::-1].tolist() and len(set(forth.tolist())) == len(set(words))
    assert all(len(own) == 0 for own in others)
