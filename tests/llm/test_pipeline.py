from collections import Counter

import corpus_pipeline as CP
import test_packing as packing_test
import test_pii as pii_test
import test_quality as quality_test
import test_simhash as simhash_test

from spanmill.llm import quality_rules, toxicity_cnn, weak_pii
from spanmill.llm.common import table, written


def test_stages_against_plain_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    before = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns

    judged = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    docs = written(CP.quality(spark, docs, sf_dir))
    kept = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(kept) == {i for i, k in judged.items() if k}
    assert not any(quality_test.brute(r.text)[-1] for r in kept.values())
    assert all(kept[i] == before[i] for i in kept)

    scores = {r.doc_id: r.score for r in toxicity_cnn.scored(docs, labels).collect()}
    docs = written(CP.toxicity(spark, docs, sf_dir))
    clean = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns
    assert set(clean) == {i for i, s in scores.items() if s < toxicity_cnn.CUTOFF}

    docs = written(CP.near_duplicates(spark, docs, sf_dir))
    rows = sorted(clean.values(), key=lambda r: r.doc_id)
    roots = simhash_test.brute_components([simhash_test.brute_fingerprint(r.text) for r in rows])
    one = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(one) == {rows[k].doc_id for k in set(roots)}
    assert len(one) < len(clean)

    docs = written(CP.personal_data(spark, docs, sf_dir))
    after = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(after) == set(one)
    for i, r in after.items():
        for kind in weak_pii.BASE:
            spans = [s for s in pii_test.brute(one[i].text) if s[3] == kind]
            assert r.text.count(f"<{kind}>") <= len(spans) + (one[i].text or "").count(f"<{kind}>")
        assert not pii_test.brute(r.text) and r.n_chars == len(r.text)
        if not pii_test.brute(one[i].text) and "<" not in r.text:
            assert r.text == one[i].text

    pieces = CP.packing(spark, docs, sf_dir).collect()
    texts = [(i, r.text) for i, r in after.items()]
    n = packing_test.check_pieces(pieces, texts, 1024)
    assert n <= -(-sum(r.length for r in pieces) // 1024) + 1
    whole = CP.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in whole) == Counter(
        (r.doc_id, r.piece, r.ids_crc32) for r in pieces)


def test_empty_documents(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert CP.run(spark, str(tmp_path)).count() == 0
