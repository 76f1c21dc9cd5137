from collections import Counter

import corpus_pipeline
from neudrift.llm.common import table
from tests.llm.test_native import lines_by_hand
from tests.llm.test_near import fingerprint, groups
from tests.llm.test_passages import hits_by_hand

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    """Every stage against a brute-force version on what the stage before kept."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "decontamination", "packing"]
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        # Plain frames, so that a stage sees exactly the rows that are compared.
        rows = stage(spark, steps[-1], SF)
        steps.append(spark.createDataFrame(rows.collect(), rows.schema))
    before = [[(r.doc_id, r.text) for r in s.collect()] for s in steps[:-1]]
    assert all(s.columns == docs.columns for s in steps[:-1])

    good = {i for i, q in labels.items() if q == 1} & {i for i, _ in before[0]}
    assert set(before[1]) <= set(before[0]) and len(good - {i for i, _ in before[1]}) <= 0.1 * len(good)
    assert Counter(before[2]) == Counter((i, t) for i, _, _, t in lines_by_hand(before[1]))
    prints = {i: fingerprint(t, 4) for i, t in before[2]}
    found, first = groups(set(prints.values()), 4), {}
    for i, p in prints.items():
        first[found[p]] = min(i, first.get(found[p], i))
    assert Counter(before[3]) == Counter((i, t) for i, t in before[2] if first[found[prints[i]]] == i)
    clean = {i for i, _, hit, _ in hits_by_hand(before[3], items, 10) if not hit}
    assert Counter(before[4]) == Counter((i, t) for i, t in before[3] if i in clean)
    packed = steps[-1].collect()
    assert {r.doc_id for r in packed} == {i for i, _ in before[4]}

    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == Counter(r.doc_id for r in packed)


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
