"""The pipeline against plain Python, stage by stage, and the registered queries."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import WHITE, exact_groups, near_duplicates, odd_documents

import __spark_entry__ as entry_points
import corpus_pipeline
from trolley.llm import bpe, mixing, toxicity
from trolley.sources.storage import settled

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents that each stage was given and what it made of them."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = settled(stage(spark, docs, FOLDER), "test-stage")
        found[name] = (docs, result)
        docs = result
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "byte_bpe"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == COLUMNS


def test_toxic_documents_go(spark, stages):
    docs, left = stages["toxicity"]
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    # The same scores, from compressing window by window here.
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert set(texts(left)) == {r["doc_id"] for r in scored if r["score"] < model.cutoff}
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in scored)
    rows = texts(docs)
    features = toxicity._features(toxicity.savings(model.dictionaries)(rows.values()))
    z = features @ np.array(model.weights[:-1]) + model.weights[-1]
    wanted = dict(zip(rows, 1 / (1 + np.exp(-np.clip(z, -30, 30)))))
    assert all(r["score"] == pytest.approx(wanted[r["doc_id"]]) for r in scored)


def test_copies_go(stages):
    docs, left = stages["exact_dedup"]
    rows = list(texts(docs).items())
    assert set(texts(left)) == {keep for keep, _ in exact_groups(rows)}


def test_near_copies_go(stages):
    docs, left = stages["jaccard_join"]
    rows = list(texts(docs).items())
    assert set(texts(left)) == {class_id for class_id, _ in near_duplicates(rows)}


def test_documents_repeat_as_mixed(stages):
    docs, mixed = stages["mixing"]
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix_sources(docs).collect()}
    wanted = {i: max(1, int(t / n + 0.5)) for i, (t, n) in taken.items() if t > 0}
    assert collections.Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == collections.Counter(wanted)
    rows = texts(docs)
    assert all(r["text"] == rows[r["doc_id"]] for r in mixed.collect())
    assert all(n == len([w for w in WHITE.split(rows[i]) if w]) for i, (_, n) in taken.items())


def test_encoded_documents(stages):
    docs, encoded = stages["byte_bpe"]
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = texts(docs)
    found = encoded.collect()
    assert len(found) == docs.count()
    for r in found:
        ids = library.encode_ordinary(rows[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]].encode()).hexdigest()


def test_queries_agree_with_their_sql(spark):
    from comparing import connect, difference

    connection = connect(FOLDER)
    for name in ("op3_warc", "op5_top_k", "op9_exact_dedup", "op11_fill_in_middle", "op12_quality_rules", "op13_phrase_collocations"):
        assert difference(entry_points.queries()[name](spark, FOLDER), connection, entry_points.oracle_sql()[name]) is None


def test_whole_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    """Null ids, repeated ids with other texts, long texts; then no rows at all."""
    odd = odd_documents(spark, extra=False).select(*COLUMNS)
    labels = spark.createDataFrame([(3, 1, 1), (None, 0, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", odd), ("empty", odd.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert all(r["n_tokens"] == len(r["ids"]) for r in found)
        assert (len(found) > 0) == (name == "odd")


def test_samples_of_labelled_documents_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CALIBRATION_DOCUMENTS", 50)
    monkeypatch.setattr(toxicity, "FIT_DOCUMENTS", 50)
    docs = spark.range(2000).selectExpr("id % 3 AS doc_id", "concat('text of ', id, ' words') AS text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id long, toxic int")
    rows = []
    monkeypatch.setattr(toxicity, "fit_logistic", lambda x, y: rows.append(len(y)) or [0.0] * 7)
    toxicity.fit(docs, labels)
    assert all(n <= 50 for n in rows)
    assert toxicity.toxicity(docs, labels).count() == 2000


def test_every_operator_has_a_query():
    numbers = {int(n[2:].split("_")[0]) for n in entry_points.queries() if n.startswith("op") and n[2].isdigit()}
    assert numbers == set(range(1, 14)) and "pipeline" in entry_points.queries()
