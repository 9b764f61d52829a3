import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from lakestrata.llm import bpe
from lakestrata.llm.common import crc_mod
from lakestrata.session import scratch_dir
from llm.test_decontaminate import brute
from llm.test_near_dup import brute_classes


def test_stages_take_effect_one_after_another(corpus):
    docs = corpus.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dup", "decontaminate", "secrets", "bpe"]
    tables = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_dir(corpus, f"test-{name}")
        stage(corpus, docs, SF_SMALL).write.parquet(path)
        tables[name] = docs = corpus.read.parquet(path)
    rows = {n: {r.doc_id: r for r in t.collect()} for n, t in tables.items()}
    assert all(tables[n].columns == tables["documents"].columns for n in names[:-1])
    # toxicity: what goes is what the operator's query predicts
    from lakestrata.llm.toxicity import op8_toxicity

    bad = {r.doc_id for r in op8_toxicity(corpus, SF_SMALL).where("predicted = 1").collect()}
    assert set(rows["toxicity"]) == set(rows["documents"]) - bad and bad
    # near duplicates: the least id of every class of what was kept
    ids = sorted(rows["toxicity"])
    classes = brute_classes([rows["toxicity"][i].text for i in ids])
    assert set(rows["near_dup"]) == {ids[c] for c in classes}
    bench = [(r.item_id, r.text) for r in corpus.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    for i, r in rows["near_dup"].items():
        n, hit, _ = brute(r.text, bench)
        assert (i in rows["decontaminate"]) == (not (hit > 0 and 20 * hit >= n))
    assert set(rows["secrets"]) == set(rows["decontaminate"]) == set(rows["bpe"])
    coder = bpe.ChunkCoder(bpe.vocabulary_path())
    for i, r in rows["bpe"].items():
        assert r.token_ids == " ".join(map(str, coder.tok.encode(r.text or "", add_special_tokens=False).ids))
    for i, r in rows["secrets"].items():
        old = rows["decontaminate"][i]
        assert r.text == old.text or "[SECRET]" in r.text


def test_run_and_registration(corpus):
    queries = entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {q[: q.index("_") + 1] for q in queries if q.startswith("op")}
    out = queries["pipeline"](corpus, SF_SMALL)
    assert out.count() > 0 and {"doc_id", "token_ids"} <= set(out.columns)


def test_pipeline_on_odd_rows(corpus, odd_docs, no_docs):
    for docs in (odd_docs.drop("n_tokens"), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_dir(corpus, f"odd-{name}")
            stage(corpus, docs, SF_SMALL).write.parquet(path)
            docs = corpus.read.schema(docs.schema).parquet(path) if name != "bpe" else corpus.read.parquet(path)


def test_hold_out_rule(corpus):
    import zlib

    df = corpus.createDataFrame([(i,) for i in (0, 7, -3, 10**12, None)], "doc_id bigint")
    got = [r.m for r in df.select(crc_mod(df.doc_id, 10).alias("m")).collect()]
    assert got == [zlib.crc32(("" if i is None else str(i)).encode()) % 10 for i in (0, 7, -3, 10**12, None)]
