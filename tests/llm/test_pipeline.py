"""The pipeline's stages against brute force, and edge rows through all of them."""

from collections import Counter

import corpus_pipeline
from marketlake.llm import decontaminate, pii, quality

from .test_operators import BASE_PII, base_spans, brute_components

SF = "/root/testdata/sf0.001"


def step(spark, name, docs, sf_dir=SF):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = step(spark, "quality_classifier", docs)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["row"].doc_id for r in quality.score(docs, labels, ["doc_id"]).where("score >= 0.7").collect()}
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) == good and 0 < len(good) < docs.count()

    one = step(spark, "simhash_near_dedup", kept)
    want = {c for _, _, c in brute_components(rows.items())}
    got = {r.doc_id: r.text for r in one.collect()}
    assert one.columns == docs.columns and set(got) == want and one.count() == len(want) < len(rows)

    clean = step(spark, "benchmark_decontamination", one)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    hits = decontaminate.brute_force(got, items)
    left = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == docs.columns and set(left) == {d for d, h in hits.items() if not h[1]}

    private = step(spark, "pii", clean)
    assert private.columns == docs.columns
    found = {r.doc_id: r for r in private.collect()}
    assert set(found) == set(left)
    for d, r in found.items():
        if not base_spans(BASE_PII, left[d].text):
            continue
        assert r.text != left[d].text and r.n_chars == len(r.text) and not base_spans(BASE_PII, r.text)

    packed = step(spark, "best_fit_packing", private).collect()
    assert {r.doc_id for r in packed} == set(found)


def test_run_equals_the_stages_in_turn(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    fills = Counter()
    for r in rows:
        fills[r.sequence_id] += r.length
    assert rows and max(fills.values()) <= 2048
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, score double, component_id long, spans string"
    texts = [None, "", "  ", "short", "mail a@b.com now", "mail a@b.com now", "x" * 50_000]
    docs = spark.createDataFrame([(i if i != 5 else 4, t, None, "s", None, 1, None, 3, "s") for i, t in enumerate(texts)]
                                 + [(None, "no id", "en", None, 5, 1, 0.1, 2, None)], schema)
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        assert out.count() > 0 or name == "quality_classifier"
        assert stage(spark, empty, SF).count() == 0
    assert {r.doc_id for r in step(spark, "simhash_near_dedup", docs).collect()} >= {0, 3, 4, None}
    redacted = [r.text for r in step(spark, "pii", docs).where("doc_id = 4").collect()]
    assert redacted == ["mail <EMAIL> now"] * 2
    assert pii.KINDS[0] == "email"


def test_near_dedup_keeps_one_row_of_each_component(spark):
    def words(k):
        return " ".join(f"w{k}x{i}" for i in range(60))
    # doc_id 7 stands on two texts: A, which has a smaller id too, and B; C has null ids only; D an id and a null id
    a, b, c, d = (words(k) for k in "abcd")
    docs = spark.createDataFrame([(7, a), (7, b), (3, a), (None, c), (None, c), (None, d), (9, d), (7, b)], "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in step(spark, "simhash_near_dedup", docs).collect())
    assert got == {(3, a): 1, (7, b): 1, (None, c): 1, (9, d): 1}
