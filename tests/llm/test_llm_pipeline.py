from __future__ import annotations

from collections import Counter

import corpus_pipeline
from brute_links import linked
from tapeloom.llm import common, jaccard, mixing, outliers, packing, pii, queries


def test_stages_keep_columns_and_take_effect(spark, crowded, folder):
    docs, seen = crowded, {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, ""), "test-stage")
        seen[name] = (docs, out)
        if name != "pack":
            assert out.columns == crowded.columns
        docs = out
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    before, after = seen["quality"]
    assert ids(after) == Counter(r.doc_id for r in outliers.judge(before).where("kept").collect())
    before, after = seen["near copies"]
    groups = jaccard.groups(before).collect()
    assert set(ids(after)) == {r.component_id for r in groups}
    assert len({r.component_id for r in jaccard.groups(after).collect()}) == after.count()
    before, after = seen["personal data"]
    assert ids(before) == ids(after)
    assert all(not pii.base_spans(r.text)[0] for r in after.collect())
    before, after = seen["mix"]
    assert {r.doc_id for r in mixing.mix(before).where("taken > 0").collect()} == set(ids(after))
    before, after = seen["pack"]
    tokens = lambda df: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert tokens(packing.pack(before)) == tokens(after)


def test_near_copies_with_changed_blocks_go(spark, docs):
    rows, copies = [], []
    for n in (60, 150, 400):
        for share in (0.03, 0.1, 0.15):
            words, k = [f"w{len(rows)}x{j}" for j in range(n)], int(n * share)
            for copy in (words, [*words[:9], *[f"c{j}" for j in range(k // 2)], *words[9 + k // 2 :]], words[:-k], [*words, *words[:3], *[f"a{j}" for j in range(k)]]):
                copies.append((len(copies), " ".join(copy), "en", "s", 0))
            rows.append(words)
    df = spark.createDataFrame(copies, docs.schema)
    want = linked(copies, 80, 5)
    assert sorted(tuple(r) for r in jaccard.groups(df, percent=80, width=5).collect()) == sorted(want)
    kept = {r.doc_id for r in corpus_pipeline.single(spark, df, "").collect()}
    assert kept == {c for _, _, c in want} and kept != {c for _, _, c in linked(copies)}


def test_run_gives_the_last_stage(spark, docs, folder):
    path = folder("tables")
    docs.write.parquet(f"{path}/documents.parquet")
    found = corpus_pipeline.run(spark, path)
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(found.columns)
    assert found.count() > 0
    assert corpus_pipeline.run(spark, path).select("doc_id", "start", "ids_crc32").exceptAll(found.select("doc_id", "start", "ids_crc32")).count() == 0


def test_a_table_without_rows(spark, empty, folder):
    path = folder("none")
    empty.write.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
