"""Property tests: Spark and the SQL oracle (DuckDB) agree on the tokenizer and the stemmer."""

import duckdb
from hypothesis import given, settings, strategies as st

from quarry.functions.porter import porter_sql, porter_stem
from quarry.functions.tokenize import sql_token_pattern, token_array

TEXT_CHARS = st.sampled_from(list("abcXYZéüñ019 .,;:-'\"()%/\n\t") + [" ", "́", "—", "…"])
WORD_CHARS = st.sampled_from(list("abcdeilmnorstuyz"))


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=TEXT_CHARS, min_size=0, max_size=40), min_size=50, max_size=50))
def test_tokenizer_spark_equals_duckdb(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id BIGINT, t STRING")
    got = {r.id: list(r.a) for r in df.select("id", token_array("t").alias("a")).collect()}
    con = duckdb.connect()
    for i, t in enumerate(texts):
        want = con.execute(f"SELECT regexp_extract_all(?, '{sql_token_pattern()}')", [t]).fetchone()[0]
        assert got[i] == want, repr(t)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=WORD_CHARS, min_size=1, max_size=12), min_size=200, max_size=200, unique=True))
def test_porter_spark_equals_duckdb(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "term STRING")
    got = {r.term: r.stem for r in porter_stem(df, "term", "stem").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE v(term VARCHAR)")
    con.executemany("INSERT INTO v VALUES (?)", [(w,) for w in words])
    want = dict(con.execute(porter_sql("v", "term", "stem")).fetchall())
    assert got == want
