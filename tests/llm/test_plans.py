"""What plans of the corpus operators must not do twice."""

from gridframe.llm import langid


def test_language_is_predicted_once_under_a_filter(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "123"), (3, None)], "doc_id long, text string")
    told = langid.predict_language(docs, {"en": b" the cat and the dog ", "de": b" die katze und der hund "}).where("lang_pred <> 'und'")
    assert told._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r["doc_id"], r["lang_pred"]) for r in told.collect()] == [(1, "en")]
