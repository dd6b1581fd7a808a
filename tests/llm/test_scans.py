"""License and secret scans, mixing, decontamination, language ID: brute force and defined cases."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from barframe.llm import license_scan, secret_scan, source_mix
from barframe.llm.decontaminate import decontamination_stage, find_leaks
from barframe.llm.language_id import UNKNOWN, gram_counts, gram_vectors, identify, language_stage
from barframe.llm.license_scan import TEMPLATES, bigram_set, find_licenses, normal_words, pivots
from barframe.llm.secret_scan import KINDS, discovery_cuts, mask, scan, with_spans
from barframe.llm.source_mix import allocate, select_tokens

from .conftest import sentence

# -- licenses


def dice(a, b):
    a, b = (set(bigram_set(normal_words(x))) for x in (a, b))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0


def test_license_best_template_by_brute_force(documents):
    rng = random.Random(2)
    texts = {1: None, 2: "", 3: "word", 4: "\n".join(["intro text here", TEMPLATES["MIT"], "Licensed under CC BY-NC 4.0."])}
    for i, t in enumerate(TEMPLATES.values()):
        ws = t.split()
        for _ in range(rng.randint(0, 3)):
            ws.insert(rng.randrange(len(ws)), "extra")
        texts[10 + i] = " ".join(ws).upper()
    want = set()
    for i, t in texts.items():
        for at, line in enumerate((t or "").split("\n")):
            best = min((-dice(line, x), name) for name, x in TEMPLATES.items())
            if -best[0] >= license_scan.MIN_DICE:
                want.add((i, at, best[1], round(-best[0], 6)))
    got = {(r["doc_id"], r["at"], r["license"], r["dice"]) for r in find_licenses(documents(texts)).where("level = 'line'").collect()}
    assert got == want and len(want) > 15


def test_license_pivots_are_necessary():
    chosen = set(pivots(TEMPLATES, 0.75))
    for t in TEMPLATES.values():
        b = bigram_set(normal_words(t))
        assert sum(not set(x.split()) & chosen for x in b) < 0.75 / 1.25 * len(b)


def test_license_empty_and_repeats(documents):
    assert find_licenses(documents({1: "x"}).limit(0)).count() == 0
    assert find_licenses(documents({(1, 0): TEMPLATES["MIT"], (1, 1): TEMPLATES["MIT"], (None, 0): TEMPLATES["MIT"]})).count() == 3


# -- secrets


def base_spans(text):
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


SECRETS = {
    1: None, 2: "", 3: "plain words only", 4: 'é𝄞 token = "abcdef123" and api_key:ABCDEFG, PASSWORD= x', 5: "token=abc secret: token=abcdefgh",
    6: "AKIA" + "A1B2" * 4 + " AKIAshort AKIAAKIA", 7: "z" + "0123456789abcdef" * 3 + "g deadbeef", 8: "secret=token:abcdefg token:token:token=abcdef",
    9: "apikey='a.b-c_d' passwd  =  \"0123456789abcdef01234567\"", 10: "TOKEN=" + "f" * 30,
}


def test_secret_base_spans(documents):
    rows = scan(documents(SECRETS).select("doc_id", "text")).collect()
    for r in rows:
        assert [(x["s"], x["k"], x["e"]) for x in r["base"]] == base_spans(SECRETS[r["doc_id"]] or "")


def test_secret_battery_tells_random_runs_from_words(documents):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = {i: "see " + "".join(rng.choice(letters) for _ in range(40)) + " there" for i in range(30)}
    words = {100 + i: "see " + sentence(i, 30).replace(" ", "")[:40] + " there" for i in range(200)}
    words |= {400: "x " + "a" * 40, 401: "y " + "ab" * 30, 402: "z " + "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"}
    scanned = scan(documents(keys | words).select("doc_id", "text"))
    got = {r["doc_id"]: [x["k"] for x in r["spans"]] for r in with_spans(scanned, discovery_cuts(scanned.select(F.inline("runs")))).collect()}
    assert sum(got[i] == [3] for i in keys) >= 28
    assert sum(bool(got[i]) for i in words) <= 2


def test_secret_query_digest(documents, spark, tmp_path):
    documents(SECRETS).write.parquet(str(tmp_path / "documents.parquet"))
    for r in secret_scan.op2_secret_scan(spark, str(tmp_path)).collect():
        want = base_spans(SECRETS[r["doc_id"]] or "")
        text = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in want) for i in range(3)]


def test_secret_stage_masks(spark, documents):
    got = {r["doc_id"]: r for r in secret_scan.secret_stage(spark, documents(SECRETS), "").collect()}
    assert len(got) == len(SECRETS)
    for i, t in SECRETS.items():
        want, at = "", 0
        for s, _, e in base_spans(t or ""):
            if s >= at:
                want += t[at:s] + secret_scan.MASK
            at = max(at, e)
        want = want + t[at:] if base_spans(t or "") else t
        assert got[i]["text"] == want
        assert got[i]["n_chars"] == (len(want) if want else None)
    assert secret_scan.secret_stage(spark, documents({1: "a"}).limit(0), "").count() == 0


# -- mixing


def test_mix_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 5)],
                                   "domain string, lang string, source string, tokens bigint")
    plan = allocate(leaves, budget_percent=50, max_epochs=1, domain_weights={"a": 1, "b": 1}, lang_weights={"x": 1, "y": 1})
    got = {r["source"]: r["budget"] for r in plan.collect()}
    # 1007 in all; b can give 5, so a gets 1002: 501 to each language; s1 is short, its sibling s2 covers it
    assert got == {"s1": 10, "s2": 491, "s3": 501, "s4": 5}


def test_mix_takes_its_budget_exactly(spark, documents):
    df = documents({i: sentence(i, i % 17) for i in range(150)}, source="s1").unionByName(documents({(None, 0): "a b", (7, 1): None}, source=None, lang=None))
    got = select_tokens(df, budget_percent=150, max_epochs=2).toPandas()
    total = int(got.n_tokens.sum())
    assert len(got) == 152 and got.tokens_taken.sum() == total * 150 // 100
    assert (got.tokens_taken <= 2 * got.n_tokens).all()
    assert select_tokens(documents({1: "a"}).limit(0)).count() == 0


def test_mix_order_is_seeded_not_by_id(documents):
    got = select_tokens(documents({i: "a b c d" for i in range(100)}), budget_percent=50, max_epochs=1).toPandas()
    taken = sorted(got[got.tokens_taken > 0].doc_id)
    assert len(taken) == 50 and taken != list(range(50))


# -- decontamination


def test_leaks_against_brute_force(spark, documents):
    items = {i: sentence(1000 + i, n) for i, n in enumerate((5, 6, 12, 30, 60, 130))} | {10: None, 11: "", 12: "two words"}
    rng = random.Random(3)
    texts = {0: None, 1: "", 2: "Two  WORDS", 3: "two words more"}
    for n in range(60):
        ws = items[rng.randrange(6)].split()
        for _ in range(rng.randint(0, 3)):
            ws[rng.randrange(len(ws))] = "x"
        texts[10 + n] = sentence(n, rng.randint(0, 300)) + "\n" + " ".join(ws[:rng.randint(len(ws) // 2, len(ws))]).upper() + " " + sentence(500 + n, 20)

    def shingles(t):
        ws = (t or "").lower().split()
        return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()
    want = {(d, i): len(shingles(t) & shingles(x)) for d, t in texts.items() for i, x in items.items()
            if shingles(x) and len(shingles(t) & shingles(x)) >= 0.75 * len(shingles(x))}
    bench = spark.createDataFrame([(i, t, 5) for i, t in items.items()] + [(None, "a b c d e", 5)], "item_id bigint, text string, h int")
    got = {(r["doc_id"], r["item_id"]): r["n_common"] for r in find_leaks(documents(texts), bench).collect()}
    assert got == want and len(want) > 10
    assert find_leaks(documents(texts), bench.limit(0)).count() == 0
    assert find_leaks(documents(texts).limit(0), bench).count() == 0


def test_decontamination_stage(spark, documents, tmp_path):
    spark.createDataFrame([(1, sentence(1, 20))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = decontamination_stage(spark, documents({1: sentence(2, 9) + " " + sentence(1, 20), 2: sentence(3, 40), 3: None}), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


# -- language


def test_language_on_small_alphabets(spark, documents):
    rng = random.Random(0)
    def text(parts):
        return " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(60))
    a, b = ["the", "an", "ing"], ["ço", "ñel", "rá"]
    docs = documents({i: text(a) for i in range(20)}, lang="xx").unionByName(documents({100 + i: text(b) for i in range(20)}, lang="yy"))
    new = documents({1: text(a), 2: text(b), 3: None, 4: "", 5: "12 34 !!", 6: text(a) * 200})
    got = {r["doc_id"]: r for r in identify(new, docs).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 7)] == ["xx", "yy", UNKNOWN, UNKNOWN, UNKNOWN, "xx"]
    assert got[3]["score"] == 0 and 0.5 < got[1]["score"] <= 1
    assert all(r["lang_pred"] == UNKNOWN for r in identify(new, docs.limit(0)).collect())
    assert identify(new.limit(0), docs).count() == 0


def test_language_binding_keeps_order_apart():
    _, g, n = gram_counts(["abc", "cba", "abcabc  abc"])
    assert n.sum() > 0
    v = gram_vectors(g[:2])
    assert set(v.ravel()) == {1.0, -1.0}
    one, two = (gram_vectors(gram_counts([t])[1]).sum(0) for t in ("xyz", "zyx"))
    assert abs((one @ two) / (one @ one) ** 0.5 / (two @ two) ** 0.5) < 0.2


def test_language_held_out_accuracy(spark):
    from barframe.llm.language_id import op9_language_id
    from barframe.llm.common import read
    sf = "/root/testdata/sf0.001"
    got = op9_language_id(spark, sf).join(read(spark, sf, "documents", "doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.97


def test_language_stage_keeps_clean_documents(spark, documents):
    texts = {i: sentence(i, 30) for i in range(30)} | {100: None, 101: "123 !!", 102: "漢字仮名交じり文" * 5}
    docs = documents({i: t for i, t in texts.items() if i < 100}).unionByName(documents({i: t for i, t in texts.items() if i >= 100}, lang=None))
    kept = language_stage(spark, docs, "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))


@pytest.mark.parametrize("weights", [{}, {"a": 0}])
def test_mix_zero_weights(spark, weights):
    leaves = spark.createDataFrame([("a", "x", "s1", 10)], "domain string, lang string, source string, tokens bigint")
    got = allocate(leaves, 100, 1, weights, {}).first()["budget"]
    assert got == (0 if weights else 10)
    assert source_mix.OTHER_WEIGHT > 0


def test_mask_of_overlapping_spans(spark):
    df = spark.createDataFrame([("0123456789", [(1, 0, 4), (2, 2, 6), (8, 1, 9)])], "t string, s array<struct<s:int,k:int,e:int>>")
    assert df.select(mask(F.col("t"), F.col("s"))).first()[0] == "0[secret]67[secret]9"
