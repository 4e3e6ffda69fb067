import duckdb
import pytest

from quarry.functions.porter import MIN_LENGTH, STEP2_RULES, STEP3_RULES, STEP4_SUFFIXES, porter_sql, porter_stem, word_stemmer

# Examples of the 1980 paper, with the stem after all steps.
PAPER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit",
    "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
    "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun",
    "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "generalizations": "gener", "is": "is", "a": "a",
}


@pytest.fixture(scope="module")
def spark_stems(spark):
    df = spark.createDataFrame([(w,) for w in PAPER], "word STRING")
    return {r.word: r.stem for r in porter_stem(df, "word", "stem").collect()}


def test_paper_examples(spark_stems):
    assert {w: spark_stems[w] for w in PAPER} == PAPER


def test_sql_rendering_agrees():
    con = duckdb.connect()
    con.execute("CREATE TABLE v(term VARCHAR)")
    con.executemany("INSERT INTO v VALUES (?)", [(w,) for w in PAPER])
    got = dict(con.execute(porter_sql("v", "term", "stem")).fetchall())
    assert got == PAPER


def test_filter_on_stem_does_not_blow_up(spark):
    df = spark.createDataFrame([("generalizations",), ("relational",)], "word STRING")
    out = porter_stem(df, "word", "stem").filter("stem = 'gener'")
    assert [r.word for r in out.collect()] == ["generalizations"]


def test_word_stemmer_agrees_with_the_columns(spark):
    stem = word_stemmer()
    assert {w: stem(w) for w in PAPER} == PAPER
    ends = [s for s, _ in STEP2_RULES + STEP3_RULES] + STEP4_SUFFIXES + ["", "s", "sses", "ies", "ed", "eed", "ing", "y", "e", "ll"]
    words = [a + b + c for a in ("", "s", "tr", "by", "oat", "hop", "fill", "ñu", "l'o", "a1") for b in ends for c in ends]
    got = {r.word: r.stem for r in porter_stem(spark.createDataFrame([(w,) for w in words], "word STRING"), "word", "stem").collect()}
    assert MIN_LENGTH == 3 and {w: stem(w) for w in words} == got
