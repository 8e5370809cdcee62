import hashlib
import string

import public_tokenizers
from test_ngram_join import grams
from tokenizers import Tokenizer

import corpus_pipeline
from contestlab.llm.mixing import mix_sources
from contestlab.llm.quality_rules import quality_rules

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(d.columns == docs.columns for d in seen[:-1])
    rows = [{r.doc_id: r.asDict() for r in d.collect()} for d in seen]
    assert all(a[i] == b[i] for a, b in zip(rows[:-2], rows[1:-1], strict=False) for i in b)  # rows pass unchanged

    kept = {r.doc_id for r in quality_rules(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.kept}
    assert rows[1].keys() == kept

    last = {}
    for i in sorted(rows[1]):
        last[rows[1][i]["text"].translate(LOWER)] = i
    assert rows[2].keys() == set(last.values())

    sets = {i: grams(r["text"]) for i, r in rows[2].items()}
    name = {i: i for i in sets}
    for _ in range(20):
        for i, a in sets.items():
            for j, b in sets.items():
                if a and 5 * len(a & b) >= 4 * len(a | b):
                    name[i] = name[j] = min(name[i], name[j])
    assert rows[3].keys() == set(name.values())

    assert rows[4].keys() == {r.doc_id for r in mix_sources(seen[3]).collect() if r.sampled}

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, r in rows[5].items():
        ids = tokenizer.encode(rows[4][i]["text"], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert rows[5].keys() == rows[4].keys()


def test_run_is_the_stages_in_order(spark, monkeypatch):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources", "BPE"]
    stages = [("one", lambda s, d, p: d.where("doc_id > 5")), ("two", lambda s, d, p: d.where("doc_id < 9")), ("three", lambda s, d, p: d.select("doc_id"))]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == [(6,), (7,), (8,)]


def test_run_of_the_real_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < got.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
