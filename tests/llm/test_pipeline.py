import corpus_pipeline
from llm_texts import texts_with_everything

from ledgerlens.llm.queries import ORACLE, QUERIES


def test_stages_and_queries():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram jaccard join", "suffix-array dedup", "best-fit packing"]
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_each_stage_works_on_what_its_predecessor_kept(spark, docs, byte_bpe, tmp_path):
    import test_exact_dedup
    import test_jaccard_join
    import test_suffix_dedup
    from tokenizers import Tokenizer

    rows = [r for r in texts_with_everything(6, 140) if r[0] is not None]
    rows = list(dict(rows).items())
    rows += [(1000 + i, f"you horrible fool number {i} go away") for i in range(60)]
    path = str(tmp_path)
    docs(rows).drop("rid").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 1000)) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    kept = spark.read.parquet(f"{path}/documents.parquet")
    names = kept.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, path)
        out.write.parquet(f"{path}/{name}")
        kept = spark.read.parquet(f"{path}/{name}")
        seen.append(kept)
        assert name == "best-fit packing" or kept.columns == names
    clean = [(i, t) for i, t in rows if i < 1000]
    assert sorted(r.doc_id for r in seen[0].collect()) == sorted(i for i, _ in clean)
    best = {}
    for i, t in clean:
        best[t or ""] = max(best.get(t or "", i), i)
    single = sorted((i, t) for t, i in best.items())
    assert sorted((r.doc_id, r.text or "") for r in seen[1].collect()) == single
    alone = [(i, t) for i, t in single if any(x[0] == str(i) == x[2] for x in test_jaccard_join.brute(single))]
    assert sorted((r.doc_id, r.text or "") for r in seen[2].collect()) == alone
    cut = {int(i): kept_bytes.decode("utf-8", "ignore") for i, *_, kept_bytes in test_suffix_dedup.brute(alone, 50)}
    assert {r.doc_id: r.text for r in seen[3].collect()} == cut
    library = Tokenizer.from_file(byte_bpe)
    sizes = {}
    for r in seen[4].collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in cut.items()}
    assert test_exact_dedup.order(None) < test_exact_dedup.order(0)
    whole = corpus_pipeline.run(spark, path)
    assert sorted(whole.columns) == sorted(seen[4].columns) and whole.count() == seen[4].count()
