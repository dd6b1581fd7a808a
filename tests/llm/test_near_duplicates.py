"""Components of near duplicates against brute force, and the defined cases."""
import itertools
import random

import numpy as np
import pytest

from barframe.llm import linking, minhash_dedup
from barframe.llm.minhash_dedup import near_duplicates

from .conftest import sentence


def shingles(text):
    ws = (text or "").encode().translate(linking.LOWER).split()
    return frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else [])


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(texts, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in texts}


def changed(text, n, seed):
    rng = random.Random(seed)
    ws = text.split()
    for at in rng.sample(range(len(ws)), n):
        ws[at] = f"new{rng.random()}"
    return " ".join(ws)


def corpus():
    base = sentence(1, 120)
    texts = {i: sentence(100 + i, 60) for i in range(1, 40)}
    texts |= {100 + i: changed(base, 1 + i % 4, i) for i in range(90)}  # a large group about the limit
    texts |= {300 + i: base for i in range(20)}  # exact copies
    texts |= {400: base.upper(), 401: None, 402: "", 403: " \t\n ", 404: "one two", 405: "One  TWO", 406: "one two three"}
    chain = sentence(5, 80)
    for i in range(6):  # each links to its neighbours only
        texts[500 + i] = chain
        chain = changed(chain, 1, i)
    return texts


def test_matches_brute_force(spark, documents):
    texts = corpus()
    got = {r["doc_id"]: r for r in near_duplicates(documents(texts)).collect()}
    want = brute(texts)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_large_mixed_nodes_are_branched_and_sliced(spark, documents, monkeypatch):
    """With tiny nodes, every text falls through the levels to the slices; the components stay right."""
    monkeypatch.setattr(linking, "SMALL_NODE", 8)
    monkeypatch.setattr(minhash_dedup, "LEVELS", 2)
    common = sentence(9, 70)
    texts = {i: common + " " + sentence(i, 45) for i in range(40)}  # similar, but not enough
    texts |= {100 + i: texts[i] for i in range(3)} | {200: changed(texts[5], 2, 1)}
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(texts)).collect()}
    assert got == {i: c for i, (_, c) in brute(texts).items()}


def test_repeated_rows_null_ids_and_empty(spark, documents):
    texts = {(1, 0): sentence(1, 30), (1, 1): sentence(1, 30), (None, 0): sentence(1, 30), (2, 0): sentence(2, 30)}
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in near_duplicates(documents(texts)).collect())
    assert got == [("1", 1, True), ("1", 1, True), ("2", 2, True), ("None", None, False)]
    assert near_duplicates(documents({1: "a"}).limit(0)).count() == 0


def test_stage_keeps_one_of_each_group(spark, documents):
    texts = corpus()
    kept = minhash_dedup.dedup_stage(spark, documents(texts), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in brute(texts).values()})


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    got = {r["item"]: r["comp"] for r in linking.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {x: root(x) for x in parent}


def test_sketch_agreement_estimates_similarity():
    a, b = np.arange(1000, dtype=np.uint64), np.arange(200, 1200, dtype=np.uint64)
    share = (linking.sketch(linking.mix(a)) == linking.sketch(linking.mix(b))).mean()
    assert share == pytest.approx(800 / 1200, abs=0.2)


def test_no_node_is_left_without_children():
    nodes = linking.mix(np.arange(20000, dtype=np.uint64))
    for level in range(1, 8):
        n = linking.chosen(nodes, level).sum(axis=1)
        assert set(n.tolist()) == {1, 2} and n.mean() == pytest.approx(3 / 2, abs=0.02)


def planted(n, size=120, seed=0):
    """Sketches of n pairs of random sets whose similarity is exactly 0.75."""
    rng = np.random.default_rng(seed)
    common = size * 6 // 7  # 6 of 8 parts shared
    rest = size - common
    for _ in range(n):
        h = rng.integers(0, 1 << 63, size * 2, dtype=np.int64).view(np.uint64)
        shared, x, y = h[:6 * rest], h[6 * rest:7 * rest], h[7 * rest:8 * rest]
        yield linking.sketch(np.concatenate((shared, x))), linking.sketch(np.concatenate((shared, y)))


@pytest.fixture(scope="module")
def pairs_at_the_limit():
    left, right = zip(*planted(5000))
    return np.stack(left), np.stack(right)


def test_minwise_functions_are_independent(pairs_at_the_limit):
    """Agreement spreads like independent draws, and codes rule no linked pair out."""
    x, y = pairs_at_the_limit
    agree = (x == y).mean(1)
    binomial = (0.75 * 0.25 / linking.SKETCH) ** 0.5
    assert agree.mean() == pytest.approx(0.75, abs=0.003) and agree.std() == pytest.approx(binomial, rel=0.04)
    assert (linking.alike(linking.code(x), linking.code(y)) >= linking.least_agreement(0.75)).all()


def test_pairs_at_the_limit_share_a_path(pairs_at_the_limit):
    x, y = (linking.paths(s, minhash_dedup.TREES, minhash_dedup.DEPTH) for s in pairs_at_the_limit)
    assert (x == y).any(1).all()


def test_recall_after_seven_branchings(pairs_at_the_limit):
    """Were all common nodes large at every level, 0.999 of the pairs at the limit would still have one."""
    x, y = pairs_at_the_limit
    first, second = (linking.paths(s, minhash_dedup.TREES, minhash_dedup.DEPTH) for s in (x, y))
    alive = [set(np.intersect1d(a, b).tolist()) for a, b in zip(first, second)]
    for level in range(1, 8):
        rows = [(i, n) for i, nodes in enumerate(alive) for n in nodes]
        pair, node = np.array([i for i, _ in rows]), np.array([n for _, n in rows], np.uint64)
        at, place = np.nonzero(linking.chosen(node, level))
        same = x[pair[at], place] == y[pair[at], place]
        alive = [set() for _ in alive]
        with np.errstate(over="ignore"):
            child = linking.mix(linking.mix(node[at] + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)) ^ x[pair[at], place].astype(np.uint64))
        for i, c in zip(pair[at][same].tolist(), child[same].tolist()):
            alive[i].add(c)
    assert np.mean([bool(a) for a in alive]) >= 0.999


def test_an_item_with_many_partners_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(linking, "PARTNERS", 7)
    base = sentence(70, 60)
    texts = {i: changed(base, 1, i) if i % 3 else sentence(1000 + i, 60) for i in range(1, 60)} | {0: base}
    pairs = spark.createDataFrame([(0, i) for i in range(1, 60)], "a bigint, b bigint")
    got = {(r["a"], r["b"]) for r in linking.verified(pairs, spark.createDataFrame(list(texts.items()), "item bigint, text string"), 75).collect()}
    assert got == {(0, i) for i in range(1, 60) if i % 3}


def test_stage_keeps_null_ids_and_separate_texts_of_one_id(spark, documents):
    a, b, c, d = (sentence(600 + i, 50) for i in range(4))
    texts = {(None, 0): a, (None, 1): b, (None, 2): None, (1, 0): a, (1, 1): b, (1, 2): changed(b, 1, 1), (2, 0): c, (3, 0): c, (3, 1): d, (3, 2): d, (4, 0): None, (4, 1): ""}
    kept = minhash_dedup.dedup_stage(spark, documents(texts), "").collect()
    null = [r["text"] for r in kept if r["doc_id"] is None]
    assert sorted(null, key=str) == sorted([a, b, None], key=str)
    real = [(r["doc_id"], r["text"]) for r in kept if r["doc_id"] is not None]
    assert sorted(i for i, _ in real) == [1, 1, 2, 3, 4]
    assert {(1, a), (2, c), (3, d)} <= set(real) and {t for i, t in real if i == 1} - {a} <= {b, texts[1, 2]}


def test_parity_rules_out_no_linked_pair():
    """Sizes and parities keep every pair at the limit or above, of small and large sets."""
    rng = np.random.default_rng(5)
    for size in (1, 4, 8, 40, 400, 4000):
        h = rng.integers(0, 1 << 63, 4 * size, dtype=np.int64).view(np.uint64)
        for common, left, right in ((6, 1, 1), (3, 1, 0), (7, 0, 1)):
            a, b, c = (np.arange(size * k) for k in (common, left, right))
            pool = rng.integers(0, 1 << 63, size * (common + left + right), dtype=np.int64).view(np.uint64)
            x, y = np.concatenate((pool[a], pool[len(a) + b])), np.concatenate((pool[a], pool[len(a) + len(b) + c]))
            same = linking.code(np.stack([linking.sketch(h)]))[0].tobytes()  # only the parity decides
            x, y = (np.frombuffer(same + linking.parity(s), np.uint8)[None] for s in (x, y))
            assert linking.allowed(x, y, 75)[1].all()


def test_pairs_below_the_limit_are_ruled_out_before_their_texts_travel(spark, documents, monkeypatch):
    """100 texts that share three quarters of their words (similarity 0.6): not all 4,950 pairs are held against one another."""
    head = sentence(11, 225)
    texts = {i: f"{head} {' '.join(f'w{i}x{j}' for j in range(75))}" for i in range(100)}
    seen, verified = [], linking.verified
    monkeypatch.setattr(linking, "verified", lambda pairs, *x: seen.append(pairs.count()) or verified(pairs, *x))
    rows = near_duplicates(documents(texts)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in rows) and sum(seen) < 300


def test_items_of_a_node_meet_their_closest_partner_first(spark):
    """Of a node's n items each names one partner, so at most n pairs go on, not n * n / 2."""
    s = np.random.default_rng(3).integers(0, 1 << 63, 300, dtype=np.int64).view(np.uint64)
    codes = spark.createDataFrame([(i, bytearray(linking.code(linking.sketch(s)[None])[0].tobytes())) for i in range(60)], "item bigint, code binary")
    nodes = spark.createDataFrame([(1, i, i) for i in range(60)], "node bigint, item bigint, comp bigint")
    assert 30 <= linking.closest_pairs(nodes, codes, 75).count() <= 60
    assert linking.small_node_pairs(nodes, codes, 75).count() == 60 * 59 // 2


def test_texts_are_fetched_once_for_all_rounds(spark, documents, monkeypatch):
    """The texts of items that may meet are joined with the documents once, however many rounds verify pairs."""
    asked, rounds, link, verified = [], [], minhash_dedup.link, linking.verified
    monkeypatch.setattr(minhash_dedup, "link", lambda items, nodes, branch, texts_of, *x: link(items, nodes, branch, lambda ids: asked.append(ids.count()) or texts_of(ids), *x))
    monkeypatch.setattr(linking, "verified", lambda pairs, *x: rounds.append(pairs.count()) or verified(pairs, *x))
    bases = [sentence(800 + i, 60) for i in range(3)]
    texts = {20 * k + i: changed(b, min(i, 1), i) for k, b in enumerate(bases) for i in range(20)} | {100 + i: sentence(900 + i, 60) for i in range(10)}
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(texts)).collect()}
    assert got == {i: c for i, (_, c) in brute(texts).items()}
    assert len(rounds) > 1 and len(asked) == 1 and asked[0] < len(texts)


def test_components_of_few_edges_take_one_round(spark, monkeypatch):
    """Edges that lie in few tasks shrink to stars there, so no round of shuffles follows, however long their paths."""
    written, materialise = [], linking.materialise
    monkeypatch.setattr(linking, "materialise", lambda df, name: written.append(name) or materialise(df, name))
    edges = [(i, i + 1) for i in range(300)] + [(1000 + 7 * i % 100, 1000 + 7 * (i + 1) % 100) for i in range(100)]
    got = {r["item"]: r["comp"] for r in linking.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(100)}
    assert written == ["edges", "around"]


def test_components_of_edges_in_many_blocks(spark, monkeypatch):
    """The same components where a block holds a few edges only."""
    import pyarrow as pa
    edges = [(i, i + 1) for i in range(50)] + [(200, 100 + i) for i in range(50)]
    monkeypatch.setattr(linking, "EDGES", 4)
    batches = [pa.RecordBatch.from_pydict({"a": [a], "b": [b]}) for a, b in edges]
    found = [x for b in linking._hung(iter(batches)) for x in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
    assert len(found) == len(edges) and all(b < a for a, b in found)
    got = {r["item"]: r["comp"] for r in linking.components(spark.createDataFrame(found, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in [200, *range(100, 150)]}


def test_a_level_verifies_its_pairs_once(spark, documents, monkeypatch):
    """Leaders', closest and remaining pairs of different levels are verified together: one round a level and two for the last nodes."""
    monkeypatch.setattr(linking, "SMALL_NODE", 8)
    monkeypatch.setattr(minhash_dedup, "LEVELS", 2)
    rounds, verified = [], linking.verified
    monkeypatch.setattr(linking, "verified", lambda pairs, *x: rounds.append(pairs.count()) or verified(pairs, *x))
    head = sentence(21, 230)
    texts = {i: f"{head} {' '.join(f'w{i % 20}x{j}' for j in range(70))} {' '.join(f'v{i}x{j}' for j in range(5))}" for i in range(60)}
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(texts)).collect()}
    assert got == {i: c for i, (_, c) in brute(texts).items()}
    assert len(rounds) <= 4


def test_few_edges_from_many_tasks_are_brought_together(spark, monkeypatch):
    """Edges of a long path that lie in as many tasks as there are partitions take no round of shuffles for each step either."""
    written, materialise = [], linking.materialise
    monkeypatch.setattr(linking, "materialise", lambda df, name: written.append(name) or materialise(df, name))
    edges = [(i, i + 1) for i in range(300)] + [(1000 + 7 * i % 100, 1000 + 7 * (i + 1) % 100) for i in range(100)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = {r["item"]: r["comp"] for r in linking.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    finally:
        spark.conf.set(key, "true")
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(100)}
    assert written == ["edges", "edges", "around"]
