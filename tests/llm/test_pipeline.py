"""The pipeline's stages one by one, each against its operator's brute force."""

import corpus_pipeline
from quarry.llm import decontaminate, quality
from quarry.llm.common import ship

from llm.test_operators import library_ids, slow_components, slow_fingerprint, slow_removed

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    ship(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup",
                                                      "benchmark_decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(t.columns == columns for t in tables[:-1])
    given, good, lined, single, clean = ({r.doc_id: r.text for r in t.collect()} for t in tables[:-1])

    scores = {r.doc_id: r.predicted for r in quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert set(good) == {d for d, p in scores.items() if p} and all(given[d] == t for d, t in good.items())

    gone = slow_removed(good.items())
    assert lined == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in good.items()}

    ids = sorted(lined)
    roots = slow_components([slow_fingerprint(lined[d]) for d in ids], 2)
    assert set(single) == {ids[r] for r in roots} and all(lined[d] == t for d, t in single.items())

    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(clean) <= set(single)
    for d, t in single.items():
        if d in clean:
            assert not any(i in decontaminate.normalise(t) for i in items)
        else:
            assert any(decontaminate.Myers(i).best(decontaminate.normalise(t))[0] <= len(i) * decontaminate.ERROR_RATE for i in items)

    pieces = {}
    for p in tables[-1].collect():
        pieces.setdefault(p.doc_id, []).append((p.start, bytes(p.ids)))
    want = dict(zip(clean, library_ids("byte_bpe_50k.json", clean.values(), 0)))
    assert {d: b"".join(x for _, x in sorted(v)) for d, v in pieces.items()} == {d: x.tobytes() for d, x in want.items()}


def test_pipeline_of_an_empty_table_and_clashing_columns(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns
    extra = spark.createDataFrame([(1, "a b c\nd", "u", "f"), (2, None, None, None), (None, "a b c", None, None)],
                                  "doc_id long, text string, _uid string, _fp string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, SF).columns == extra.columns
