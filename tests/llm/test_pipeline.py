"""The corpus pipeline on a small table: every stage's decisions take effect."""

import corpus_pipeline
from fareline.llm import mixing, toxicity
from fareline.llm.common import table


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_files"]


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    net = toxicity.fit(docs, table(spark, sf, "labels"))
    low = {r["doc_id"] for r in toxicity.score(docs, net).where("predicted = 0").collect()}
    kept, rows = [], docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, sf)
        if name != "token_files":
            assert rows.columns == docs.columns
            rows = rows.cache()
        kept.append(sorted(r["doc_id"] for r in rows.select("doc_id").collect()))
    assert set(kept[0]) == low
    assert set(kept[1]) < set(kept[0]) and len(set(kept[1])) == len(kept[1])
    assert set(kept[2]) <= set(kept[1]) and set(kept[3]) <= set(kept[2])
    assert max(kept[3].count(i) for i in set(kept[3])) <= mixing.MOST_REPEATS
    assert kept[4] == kept[3]
