"""Training sequences follow the mixed order of the sources."""

import corpus_pipeline
from texts import SCHEMA, everything, prose, rows

LONG = 1500


def documents(spark):
    sources = [(2000 + i, t, None, "ab"[i % 2], len(t)) for i, t in enumerate(prose(5, 240, longest=LONG))]
    return spark.createDataFrame(rows(everything()) + sources, SCHEMA).repartition(3)


def test_weights_decide_the_sequences(spark, monkeypatch):
    docs = documents(spark)
    found = {}
    for heavy, light in ("ab", "ba"):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", {heavy: 20, light: 1})
        packed = corpus_pipeline.packing(spark, docs, "").collect()
        per = {}
        for r in packed:
            per.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert sorted(per) == list(range(len(per)))
        for parts in per.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 1024
        early = [r for r in packed if r.sequence_id < len(per) // 3 and (r.doc_id or 0) >= 2000]
        own = sum(r.length for r in early if "ab"[r.doc_id % 2] == heavy)
        assert own > 0.7 * sum(r.length for r in early)
        found[heavy] = sorted(((r.doc_id or 0), r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert found["a"] == found["b"]


def test_no_documents(spark):
    assert corpus_pipeline.packing(spark, documents(spark).limit(0), "").collect() == []
