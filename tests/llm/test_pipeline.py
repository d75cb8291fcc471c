import corpus_pipeline
from contrail.llm import toxicity
from contrail.llm.queries import MIX_SEED, MIX_SHARE, MIX_WEIGHTS, queries
from contrail.session import cut_lineage
import test_decontaminate
import test_mixing
import test_ngram_join


def test_stages_against_plain_versions(spark, small):
    """Each stage against a plain version on what its predecessor kept; then run()."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    scored = toxicity.toxicity_scores(docs, spark.read.parquet(f"{small}/labels.parquet")).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = cut_lineage(stage(spark, docs, small))
        kept[name] = ({r.doc_id for r in docs.collect()}, before)
    after, _ = kept["toxicity"]
    assert after == {r.doc_id for r in scored if r.score < toxicity.THRESHOLD}
    after, before = kept["quality rules"]
    # so few labels certify no cutoff: only the base rule rejects
    assert labels and after == {i for i, t in before.items() if not base_failed(t)}
    after, before = kept["n-gram Jaccard join"]
    assert after == {d for d, _, c in test_ngram_join.brute_force(sorted(before.items()), 5, 80) if d == c}
    after, before = kept["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert after == {r[0] for r in test_decontaminate.brute_force(sorted(before.items()), items) if not r[5]}
    _, before = kept["source mixture"]
    assert sum(r.n_taken for r in docs.collect()) == sum(len(t.split()) for t in before.values()) * MIX_SHARE[0] // MIX_SHARE[1]
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == sorted(map(tuple, docs.collect()))
    assert MIX_SEED and MIX_WEIGHTS and test_mixing.LEVELS == ("domain", "lang", "source")


def base_failed(text):
    from test_quality_rules import repeated

    words = text.split()
    return len(words) < 50 or 100 * repeated(words) > 50 * len(words)


def test_every_operator_has_a_query():
    names = [n.split("_")[0] for n in queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 11)) and "pipeline" in queries()
