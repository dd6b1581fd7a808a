"""The pipeline as a whole, and the SQL twins of the corpus queries."""
import os

import pytest

import corpus_pipeline
from barframe.llm.common import read
from barframe.llm.queries import QUERIES, SQL
from barframe.plans.compare import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, name):
    r = compare(QUERIES[name](spark, SF), duckdb_connection(SF), SQL[name])
    assert r["cols_match"] and r["hash_match"], r


def test_stages_keep_columns_and_shrink(spark):
    docs = read(spark, SF, "documents")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        new = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert new <= ids, name
        ids = new
        if name != "source_mix":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert ids


def test_pipeline_on_an_empty_table(spark, tmp_path):
    read(spark, SF, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    os.symlink(f"{SF}/benchmark.parquet", tmp_path / "benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_registers_all():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}


def test_rows_keep_their_own_figures(spark, documents, tmp_path):
    """Null ids, two texts of one id and repeated rows through the stages: each row once, with its own tokens."""
    from barframe.llm.decontaminate import decontamination_stage
    from barframe.llm.source_mix import mix_stage

    from .conftest import sentence

    item = sentence(50, 30)
    texts = {(None, 0): sentence(1, 20), (None, 1): sentence(2, 30) + " " + item, (None, 2): None, (None, 3): sentence(3, 9), (None, 4): sentence(3, 9), (1, 0): sentence(4, 4),
             (1, 1): sentence(5, 50), (1, 2): item, (2, 0): sentence(6, 25), (3, 0): item.upper() + " more", (4, 0): ""}
    spark.createDataFrame([(7, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = decontamination_stage(spark, documents(texts), str(tmp_path))
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = sorted(((k[0], t) for k, t in texts.items() if item not in (t or "").lower()), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == want
    mixed = mix_stage(spark, clean, str(tmp_path)).collect()
    assert len(mixed) <= len(want) and all((r["doc_id"], r["text"]) in want for r in mixed)
    for r in mixed:
        n = len(r["text"].split())
        assert r["n_tokens"] == n and r["epochs"] * n <= r["tokens_taken"] <= (r["epochs"] + 1) * n and r["tokens_taken"] > 0
    seen = [(r["doc_id"], r["text"]) for r in mixed]
    assert all(seen.count(x) <= want.count(x) for x in seen)
    assert sum(i is None for i, _ in seen) >= 2


def test_stages_one_after_another_on_odd_rows(spark, documents):
    from .conftest import sentence
    texts = {(None, 0): sentence(1, 80), (None, 1): sentence(2, 80), (5, 0): sentence(3, 80), (5, 1): sentence(4, 80), (6, 0): sentence(3, 80), (7, 0): None}
    docs = documents(texts)
    for name, stage in corpus_pipeline.STAGES:
        if name == "language_id":
            continue
        docs = stage(spark, docs, SF)
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert len(rows) == len(set(rows)) and set(rows) <= {(k[0], t) for k, t in texts.items()}, name
        if name != "source_mix":  # the mix takes its budget only; nothing else goes but the copy
            assert {t for _, t in rows} == set(texts.values()) and len(rows) == 5, name
    assert len(rows) >= 2
