from ledgerleaf.operators import learn


def test_clusters_take_the_tokens_that_are_there(spark):
    """Neither the fit nor the scores go back to the texts."""
    rows = [(i, ["apple", "pear", "plum"] if i % 2 else ["bolt", "screw", "nut"]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id INT, tokens ARRAY<STRING>")
    model = learn.fit_clusters(docs, k=2)
    scored = learn.centre_distance(model, model.transform(docs)).select("doc_id", "cluster", "distance").collect()
    odd, even = ({r["cluster"] for r in scored if r["doc_id"] % 2 == side} for side in (1, 0))
    assert len(odd) == len(even) == 1 and odd != even
    assert all(r["distance"] < 1e-6 for r in scored)


def test_documents_are_scored_once(spark, sf_dir):
    from ledgerleaf.plans.learning import clustered
    from ledgerleaf.sources.tables import Tables

    _model, scored = clustered(Tables(spark, sf_dir), "text")
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert scored.columns == ["text", "cluster", "distance"] and "UDF" not in plan and "Relation" not in plan
