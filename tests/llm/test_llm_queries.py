"""Every query of the operators: those with SQL against it, the others for rows and columns."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from vecsink.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op5_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op8_language_id": ["doc_id", "held_out", "lang_pred", "score", "bits", "rejected"],
    "op11_quality": ["doc_id", "held_out", "score", "predicted"],
}


def test_thirteen_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) | set(COLUMNS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_its_columns(spark, name):
    frame = QUERIES[name](spark, SF)
    assert frame.columns == COLUMNS[name] and frame.count() > 0


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    """Stages by plain rules on a small corpus; each works on what the one before it kept."""
    import corpus_pipeline
    from test_text_operators import found_components, found_repeats, plain_components, plain_contaminated, plain_repeats

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    for (name, stage), rule in zip(corpus_pipeline.STAGES[:4], ("toxic", "near", "repeats", "leaks"), strict=True):
        frame = stage(spark, docs, SF)
        assert frame.columns == list(corpus_pipeline.COLUMNS)
        frame.write.parquet(str(tmp_path / rule))
        after = spark.read.parquet(str(tmp_path / rule))
        kept = {r.doc_id: r.text for r in after.collect()}
        if rule == "toxic":
            assert toxic & before.keys() - kept.keys() == toxic & before.keys()
            assert len(before.keys() - kept.keys() - toxic) <= 2
        elif rule == "near":
            # Five-word shingles; found_components uses the same rule on the same rows.
            assert kept.keys() == {d for d, _, c in plain_components(list(before.items()), 5, 80) if d == c}
            assert found_components(docs) == plain_components(list(before.items()), 5, 80)
        elif rule == "repeats":
            plain = {d: (n, t) for d, _, n, t in plain_repeats(list(before.items()))}
            assert kept == {d: plain[d][1] if plain[d][0] else before[d] for d in before}
            assert found_repeats(docs) == plain_repeats(list(before.items()))
        else:
            assert kept.keys() == {d for d, _, n, _ in plain_contaminated(list(before.items()), items) if n == 0}
        docs, before = after, kept
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == before.keys()


def test_pipeline_of_nothing(spark, tmp_path):
    import shutil

    import corpus_pipeline

    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").where("false").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
