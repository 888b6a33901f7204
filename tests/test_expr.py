"""Scalar expressions on the edge rows of FIXTURES.md section C."""

import math

from pyspark.sql import functions as F

from bundles.functions import expr as X


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def col_values(df):
    return [r[0] for r in df.collect()]


def test_clean_price(spark):
    df = one_col(spark, ["12.5", "—", "$12.99", " 1.5 ", "nan", "", None, "3.25"])
    got = col_values(df.select(X.clean_price("x")))
    assert got == [12.5, None, None, 1.5, None, None, None, 3.25]


def test_rating_int_and_binary(spark):
    df = one_col(spark, [None, "0", "1", "5", "6", "text", "4.9"])
    assert col_values(df.select(X.rating_int("x"))) == [0, 0, 1, 5, 6, 0, 4]
    df2 = one_col(spark, [None, 0, 1, -1], "int")
    assert col_values(df2.select(X.binary("x"))) == [0, 0, 1, 0]


def test_clip_keeps_null(spark):
    df = one_col(spark, [None, 0, 5, 6, 10**9], "bigint")
    assert col_values(df.select(X.clip("x", upper=5))) == [None, 0, 5, 5, 5]


def test_half_even_mean(spark):
    df = one_col(spark, [2.25, 2.35, 2.45], "double")
    assert col_values(df.select(F.bround("x", 1))) == [2.2, 2.4, 2.4]


def test_list_dialects(spark):
    vals = ["[]", "['A','b']", '["A","men\'s"]', "[1,'a'", "none", "", None]
    df = one_col(spark, vals)
    py = col_values(df.select(X.parse_py_list("x")))
    assert py == [[], ["A", "b"], ["A", "men's"], [], [], [], []]
    strict = col_values(df.select(X.parse_json_list("x")))
    assert strict == [[], [], ["A", "men's"], [], [], [], []]
    joined = col_values(df.select(X.list_text("x")))
    assert joined == ["", "A b", "A men's", "[1,'a'", "none", "", ""]


def test_levels_leaf_depth(spark):
    df = spark.createDataFrame([([],), (["A"],), (["A", " B "],), (["a", "b", "c", "d", "e"],),
                                (["a", "b", "c", "d", "e", "f"],)], "x array<string>")
    assert col_values(df.select(X.level("x", 1))) == [None, None, "b", "b", "b"]
    assert col_values(df.select(X.leaf("x"))) == [None, "a", "b", "e", "f"]
    assert col_values(df.select(X.depth("x"))) == [0, 1, 2, 5, 6]


def test_images(spark):
    vals = [
        "[{'variant': 'PT01', 'hi_res': 'h1', 'large': 'l1', 'thumb': 't1'}, {'variant': 'MAIN', 'hi_res': 'H', 'large': 'L', 'thumb': 'T'}]",
        "[{'variant': 'PT01', 'hi_res': None, 'large': 'l1', 'thumb': 't1'}]",
        "[]",
        "[{'variant': 'MAIN', 'hi_res': None, 'large': None, 'thumb': 'T'}]",
        "None",
    ]
    df = one_col(spark, vals).select(X.parse_images("x").alias("i"))
    assert col_values(df.select(X.main_image("i"))) == ["H", "l1", None, "T", None]
    assert col_values(df.select(X.image_count("i"))) == [2, 1, 0, 1, 0]
    assert col_values(df.select(X.hi_res_list("i"))) == [["h1", "H"], ["l1"], [], [None], None]


def test_text_cleaners(spark):
    df = one_col(spark, ['  ["Hello"] ', "{x}", " None ", "[]", "Keep,Rest", None])
    assert col_values(df.select(X.clean_text("x"))) == ["hello", "x", "none", "", "keep,rest", None]
    assert col_values(df.select(X.smart_clean("x", "text"))) == ['["hello"]', "{x}", None, None, "keep,rest", None]
    assert col_values(df.select(X.title_head("x"))) == ['  ["Hello"] ', "{x}", " None ", "[]", "Keep", None]


def test_log1p_and_millis(spark):
    df = one_col(spark, [0.0, -1.0, math.e - 1], "double")
    got = col_values(df.select(X.log1p("x")))
    assert got[0] == 0.0 and got[1] is None and abs(got[2] - 1.0) < 1e-12
    ts = spark.createDataFrame([(0,), (1700000000123,)], "x bigint").select(
        F.date_format(X.millis_to_ts("x"), "yyyy-MM-dd HH:mm:ss.SSS"))
    assert col_values(ts) == ["1970-01-01 00:00:00.000", "2023-11-14 22:13:20.123"]


def test_none_inside_words_and_urls_stays(spark):
    from bundles.functions import expr as X
    rows = [("['None of these', 'Bike']",), ("[None, 'a', \"b, None, c\"]",), ('["He said None"]',), ("plain None",), ("['it\\'s None']",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(X.parse_py_list("t")).collect()]
    assert got == [["None of these", "Bike"], [None, "a", "b, None, c"], ["He said None"], [], ["it's None"]]
    url = "[{'variant': 'MAIN', 'hi_res': None, 'large': 'https://h/None-1.jpg', 'thumb': ''}]"
    assert spark.createDataFrame([(url,)], "t string").select(X.main_image(X.parse_images("t"))).first()[0] == "https://h/None-1.jpg"


def test_bare_none_in_linear_time(spark):
    """A list of a megabyte with as many None as words is parsed well under the old quadratic time."""
    import time

    from bundles.functions import expr as X
    text = "[" + ", ".join(["None", "'None it''s'".replace("''", "\\'")] * 45_000) + "]"
    df = spark.createDataFrame([(text,), ("['a', None, \"b None 'c'\", None]",), ("[None]",), ("None",), ("['open None",)], "x string")
    spark.range(1).select(X.parse_py_list(F.lit("[None, 'a']"))).collect()
    start = time.time()
    got = [r[0] for r in df.select(X.parse_py_list("x")).collect()]
    assert time.time() - start < 8 and len(text) >= 900_000
    assert len(got[0]) == 90_000 and got[0][:2] == [None, "None it's"] and got[1:] == [["a", None, "b None 'c'", None], [None], [], []]
