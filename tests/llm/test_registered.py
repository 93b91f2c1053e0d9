"""Every registered query of the folder over whole tables, with the columns its users rely on."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES
from tests.llm import brute

COLUMNS = {
    "op1_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2_neighbours": "query_id rank vec_id score",
    "op3_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op4_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_quality": "doc_id expected_grade p_tail accepted",
    "op6_chat": "conv_id perspective segment n_turns text mask",
    "op7_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_near_duplicates": "doc_id n_shingles component_id kept",
    "op9_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10_html_text": "page_id url text n_chars",
    "op11_fill_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op13_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "pipeline": "doc_id piece start length ids_crc32 sequence_id offset",
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    assert rows.columns == COLUMNS[name].split()
    tables = {"op2_neighbours": "embeddings", "op4_warc": "pages", "op10_html_text": "pages", "op6_chat": "conversations"}
    table = spark.read.parquet(f"{sf_dir}/{tables.get(name, 'documents')}.parquet")
    got = rows.collect()
    if name in ("op2_neighbours", "op6_chat", "op3_packing", "pipeline"):
        assert got
    else:
        assert len(got) == table.count()


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The documents that go into each stage, and what comes out of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(spark.createDataFrame(stage(spark, seen[-1], sf_dir).collect(), stage(spark, seen[-1], sf_dir).schema))
    return seen


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_pipeline_stages_against_brute_force(spark, sf_dir, stages):
    columns = stages[0].columns
    assert all(s.columns == columns for s in stages[:-1])
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {d for d, _ in texts(stages[1])}
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(d in kept for d in clean) >= 0.95 * len(clean)
    assert sum(d in kept for d in labels if labels[d].toxic == 1) <= 0.2 * sum(r.toxic == 1 for r in labels.values())
    components = brute.near_duplicates(texts(stages[1]))
    assert sorted(texts(stages[2])) == sorted((d, t) for d, t in texts(stages[1]) if components[d][1] == d)
    removed = brute.removed(texts(stages[2]))
    after = dict(texts(stages[3]))
    assert set(after) == set(removed)
    for doc, text in texts(stages[2]):
        n_bytes, gone, _, digest = removed[doc]
        assert n_bytes - gone - 12 <= len(after[doc].encode()) <= n_bytes - gone
        if hashlib.sha256(after[doc].encode()).hexdigest() != digest:  # a character was cut in two
            assert len(after[doc].encode()) < n_bytes - gone
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = {row[0] for row in brute.contamination(texts(stages[3]), items) if row[5]}
    assert sorted(texts(stages[4])) == sorted((d, t) for d, t in after.items() if d not in dirty)
    assert {r.doc_id for r in stages[5].collect()} == set(after) - dirty


def test_run_is_the_stages(spark, sf_dir, stages):
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(tuple(r[k] for k in key) for r in run.collect()) == sorted(tuple(r[k] for k in key) for r in stages[5].collect())
