from pyspark.sql import functions as F

from quarry.functions.tokenize import token_array
from quarry.operators.positions import tokenize_docs


def toks(spark, text):
    return spark.createDataFrame([(text,)], "t STRING").select(token_array("t").alias("a")).first()["a"]


def test_sentence(spark):
    assert toks(spark, "Thank you for your interest.") == ["Thank", "you", "for", "your", "interest", "."]


def test_words_and_numbers_stay_whole(spark):
    got = toks(spark, "3rd 2010-2011 1,000 3.14 H2O peer-reviewed")
    assert got == ["3rd", "2010-2011", "1,000", "3.14", "H2O", "peer-reviewed"]


def test_punctuation_tokens(spark):
    assert toks(spark, "50% (a), b; c: d - e... f -- g") == [
        "50", "%", "(", "a", ")", ",", "b", ";", "c", ":", "d", "-", "e", "...", "f", "--", "g"]


def test_blank_and_null(spark):
    df = spark.createDataFrame([(1, "   \n\t "), (2, None), (3, "x")], "doc_id BIGINT, text STRING")
    rows = tokenize_docs(df).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos, r.token) for r in rows] == [(3, 1, "x")]


def test_positions_are_one_based(spark, docs_factory):
    rows = tokenize_docs(docs_factory([(7, "a b. c")])).orderBy("pos").collect()
    assert [(r.pos, r.token) for r in rows] == [(1, "a"), (2, "b"), (3, "."), (4, "c")]
