from collections import Counter, defaultdict

import duckdb

import corpus_pipeline
from sampletide.llm import minhash, mixing, packing, pii, queries, toxicity
from tests.llm.test_minhash import plain as plain_groups
from tests.llm.test_pii import plain as plain_pii

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, kept_table):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    (n1, f1), (n2, f2), (n3, f3), (n4, f4), (n5, f5) = corpus_pipeline.STAGES
    assert [n1, n2, n3, n4, n5] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    clean = kept_table(f1(spark, docs, SF), "test")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.score(docs, labels, kept_table).where("predicted = 1").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - rejected
    single = kept_table(f2(spark, clean, SF), "test")
    groups = plain_groups([(r.doc_id, r.text) for r in clean.collect()], 5, 80)
    assert {r.doc_id for r in single.collect()} == {d for d, (_, c) in groups.items() if c == d}
    masked = kept_table(f3(spark, single, SF), "test")
    before = {r.doc_id: r.text for r in single.collect()}
    for r in masked.collect():
        assert not plain_pii(r.text) and r.n_chars == len(r.text)
        if not plain_pii(before[r.doc_id]) and "<" not in r.text:
            assert r.text == before[r.doc_id]
    mixed = kept_table(f4(spark, masked, SF), "test")
    con = duckdb.connect()
    con.register("documents", masked.toArrow())
    copies = {i: c for i, *_, c in con.execute(mixing.TAKEN_SQL).fetchall() if c}
    assert Counter(r.doc_id for r in mixed.collect()) == copies
    packed = f5(spark, mixed, SF).collect()
    assert sum(r.n_words for r in packed) == sum(len(minhash_words(r.text)) for r in mixed.collect())
    room = defaultdict(int)
    for r in packed:
        room[r.bin_id] += r.n_words
    room.pop(None, None)
    assert max(room.values()) <= packing.CAPACITY
    for stage in (clean, single, masked, mixed):
        assert stage.columns == columns


def minhash_words(text):
    return (text or "").encode().split()


def test_one_query_for_each_operator(spark):
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)
    assert pii.KINDS == ("email", "ip", "card", "phone") and minhash.PERCENT == 80


def test_stages_take_empty_tables(spark, no_documents, kept_table):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
