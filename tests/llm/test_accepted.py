"""The language stage: what the network decides, and what stays without one."""

from casebook.llm import langid


def test_missing_language_is_predicted(spark, small):
    docs = spark.createDataFrame([(k, t, None if k % 3 == 0 else "xx") for k, t in small], "doc_id long, text string, lang string")
    left = langid.accepted(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    assert len(rows) > 100 and all(r.lang == "xx" for r in rows)


def test_lettered_texts_stay_where_nothing_is_learned(spark):
    rows = [(1, "some text", None), (2, "12 34", None), (3, None, None), (4, "é", None), (5, "", None)]
    left = langid.accepted(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(tuple(r) for r in left.collect()) == [rows[0], rows[3]]
