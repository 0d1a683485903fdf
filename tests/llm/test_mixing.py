import math

from texts import everything, frame

from starload.llm.mixing import mix


def test_mix_keeps_every_row_and_its_weights(spark):
    hot = [(1000 + i, "hot") for i in range(300)]
    docs = frame(spark, everything() + hot).selectExpr(
        "*", "CASE WHEN doc_id >= 1000 THEN 'hot' ELSE source END AS other", "1 AS mix_slot", "2 AS n"
    ).drop("source").withColumnRenamed("other", "source")
    got = mix(docs, {"hot": 3, "s0": 1}, block_rows=2)
    assert set(docs.columns) - {"mix_slot"} < set(got.columns)
    rows = got.collect()
    assert len(rows) == docs.count()
    assert len({r.mix_position for r in rows}) == len(rows)
    first = [r for r in rows if r.mix_phase == 0]
    per = {}
    for r in first:
        assert r.mix_release <= r.mix_slot < r.mix_deadline
        per.setdefault(r.source or "", set()).add(r.mix_slot)
    share = {"hot": 3, "s0": 1, "": math.sqrt(3), "s1": math.sqrt(22), "s2": math.sqrt(22)}
    slots = max(max(s) for s in per.values()) + 1
    assert abs(len(per["hot"]) / len(per["s0"]) - 3) < 1
    assert slots == sum(len(s) for s in per.values())
    assert set(per) == set(share)


def test_one_source_and_none(spark):
    assert mix(frame(spark, [])).collect() == []
    rows = mix(frame(spark, [(3, "a"), (6, "b")])).collect()
    assert sorted(r.mix_position for r in rows) == [0, 1]
