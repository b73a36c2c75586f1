import corpus_pipeline
from sessionlab.llm.common import stored

FOLDER = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_the_columns(spark):
    """Every stage on a text or two whose fate is known, and nothing else lost."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain = lambda name, n=300: " ".join(f"{name}{i * i % 997}x" for i in range(n))
    near = plain("near")
    passage = plain("passage", 80)
    rows = [
        (10**6, plain("toxic") + " idiot moron, worthless scum idiot trash"),
        (10**6 + 1, plain("copy")),
        (10**6 + 2, plain("copy")),
        (10**6 + 3, near),
        (10**6 + 4, near + " changed"),
        (10**6 + 5, plain("left") + " " + passage + " " + plain("one")),
        (10**6 + 6, plain("right") + " " + passage + " " + plain("two")),
    ]
    planted = spark.createDataFrame(
        [(i, t, "en", "planted", len(t)) for i, t in rows], docs.schema
    )
    frames = [docs.unionByName(planted)]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], FOLDER), name.replace(" ", "_")))
    ids = [{r.doc_id - 10**6 for r in f.filter("doc_id >= 1000000").select("doc_id").collect()} for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert ids[1] == {1, 2, 3, 4, 5, 6}
    assert ids[2] == {2, 3, 4, 5, 6}
    assert ids[3] == {2, 3, 5, 6}
    cut = {r.doc_id - 10**6: r for r in frames[4].filter("doc_id >= 1000000").collect()}
    assert set(cut) == {2, 3, 5, 6} and passage not in cut[5].text and passage not in cut[6].text
    assert cut[2].text == plain("copy") and all(r.n_chars == len(r.text) for r in cut.values())
    assert {r.doc_id for r in frames[5].collect()} == {r.doc_id for r in frames[4].collect()}
    assert frames[2].count() > 0.6 * docs.count()
