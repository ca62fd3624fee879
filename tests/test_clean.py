from conftest import rows
from pyspark.sql import functions as F

from cuvee.functions import text
from cuvee.operators import clean
from cuvee.sources.reviews import read_reviews_csv, read_split, write_reviews_csv, write_split


def one(spark, expression, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_category(spark):
    assert one(spark, text.normalize_category, None, "Côte d'Or", "STRAßE", "Ærø", "", "_x_") == [
        "_missing_", "cote d'or", "strasse", "aero", "", "_x_",
    ]


def test_fold_marks(spark):
    assert one(spark, text.fold, "O’Keefe", "é", "Łódź", "a—b…", "“q”") == ["O'Keefe", "e", "Lodz", "a--b...", '"q"']


def test_year(spark):
    titles = [None, "no year", "Wine 2012 Red", "10000 Vines 2012", "19 Crimes", "Wine 1999", "x٢٠١٢"]
    assert one(spark, text.title_year, *titles) == [None, None, 2012.0, 10000.0, None, 1999.0, 2012.0]


def test_title(spark):
    titles = [None, "Wine 2012 X (Alto (A) B) ", "A  B   C", "Wine 1999", "12 34 x", "(a) b (c)", "a (b) c"]
    assert one(spark, text.clean_title, *titles) == ["_missing_", "wine x ", "a b c", "wine 1999", "x", "", "a (b) c"]


def test_place_mismatch(spark):
    df = spark.createDataFrame(
        [
            (1, "t (Napa)", "California", "Napa", None),
            (2, "t (Elsewhere)", "California", "Napa", None),
            (3, "t (Elsewhere)", None, None, None),
            (4, "no place", "a", "b", "c"),
            (5, None, "a", "b", "c"),
        ],
        "row_id long, title string, province string, region_1 string, region_2 string",
    )
    assert [r[0] for r in rows(clean.title_place_mismatch(df), "row_id")] == [2, 3]


def test_implication(spark):
    df = spark.createDataFrame([(None, "x"), ("a", None), (None, None), ("b", "y")], "a string, b string")
    assert clean.implication_violations(df, "a", "b").first()[0] == 1


RAW = [
    (0, "Italy", 'Say "hi", twice', None, 90, None, "P", "R", None, "T", None, "Ça 2012 (X)", "V", "W"),
    (1, None, " leading, and trailing ", "D", 80, 12.5, None, None, "S", None, None, None, None, "é"),
]


def test_csv_round_trip(spark, folder):
    from cuvee.schema import RAW_SCHEMA

    df = spark.createDataFrame(RAW, RAW_SCHEMA)
    write_reviews_csv(df, folder + "/csv")
    assert rows(read_reviews_csv(spark, folder + "/csv")) == rows(df)


def test_csv_missing_spellings(spark, folder):
    path = folder + "/in.csv"
    with open(path, "w") as f:
        f.write(",country,description,designation,points,price,province,region_1,region_2,taster_name,")
        f.write("taster_twitter_handle,title,variety,winery\n")
        f.write('7,NA,"a, ""b""",NaN,88,,n/a,null,"",x,y,z,N/A,w\n')
        f.write("8,US,d,e,91,NaN,p,q,r,s,t,u,v,Nan\n")
    first, second = sorted(read_reviews_csv(spark, path).collect())
    assert tuple(first) == (7, None, 'a, "b"', None, 88, None, None, None, None, "x", "y", "z", None, "w")
    assert second["price"] is None and second["winery"] == "Nan"


def test_split_store(spark, folder):
    df = spark.createDataFrame([(0, "test"), (1, "train"), (2, "train")], "row_id long, split string")
    write_split(df, folder + "/s")
    back = read_split(spark, folder + "/s", "train")
    assert rows(back) == [(1,), (2,)]
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().toString()


def test_cleaning_is_built_in_expressions(spark, sf_dir):
    from cuvee.plans import catalog

    for query in (catalog.normalize_categories, catalog.title_clean, catalog.document_tokens):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_csv_keeps_quoted_line_breaks_and_doubled_quotes(spark, folder):
    from cuvee.schema import RAW_SCHEMA

    raw = [(i, "Italy", f'line one\nline "two"\r\n\n{i}', None, 90, 1.5, None, None, None, None, None, "t", "v", "w") for i in range(20)]
    write_reviews_csv(spark.createDataFrame(raw, RAW_SCHEMA).repartition(3), folder)
    assert rows(read_reviews_csv(spark, folder)) == sorted(raw, key=repr)


BROKEN = [
    "0,Italy,d,,90,1.5,,,,,,t,v,w",
    "1,Italy,d,,ninety,1.5,,,,,,t,v,w",
    "2,Italy,d,,90,cheap,,,,,,t,v,w",
    "x3,Italy,d,,90,1.5,,,,,,t,v,w",
    ",Italy,d,,90,1.5,,,,,,t,v,w",
    "5,Italy,d,,90,1.5",
    "6,Italy,d,,90,1.5,,,,,,t,v,w,more",
]


def test_malformed_reviews_are_told_not_dropped(spark, folder):
    import pathlib

    import pytest

    from cuvee.sources.reviews import malformed_reviews

    path = pathlib.Path(folder, "broken.csv")
    path.write_text("\n".join([",".join("abcdefghijklmn"), *BROKEN]) + "\n")
    for multi_line in (True, False):
        told = rows(malformed_reviews(spark, str(path), multi_line).select("reason"))
        assert told == [
            ("no row id",), ("points is no int",), ("price is no double",), ("row_id is no bigint",),
            ("wrong number of cells",), ("wrong number of cells",),
        ]
        assert rows(read_reviews_csv(spark, str(path), multi_line, malformed="separate"), "row_id") == [(0,)]
        with pytest.raises(Exception, match="malformed review"):
            read_reviews_csv(spark, str(path), multi_line).count()


def test_symbols_are_spelled_out(spark):
    found = one(spark, text.fold, "½ glass", "20°", "€5 £6 ¥7", "©®™", "¡hola! ¿no?", "2×3", "a•b", "a\u2009b\u200bc", "x‐y―z", "‚q‛ „r‟", "soft\u00adhyphen")
    assert found == [
        "1/2 glass", "20deg", "EUR5 PS6 Y=7", "(c)(r)(tm)", "!hola! ?no?", "2x3", "a*b", "a bc", "x-y--z", ",q' ,,r\"", "softhyphen",
    ]


def test_stop_list_is_the_published_one():
    import hashlib

    from cuvee.functions.words import STOP_WORDS

    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 179
    assert hashlib.sha256(" ".join(STOP_WORDS).encode()).hexdigest() == "953ad8b2cc7cebba617759ed5b826cd72e373bae3d5d8f34dd7d745c10a94212"


def test_compressed_csv_keeps_rows_in_bounded_files(spark, folder, monkeypatch):
    import gzip
    from pathlib import Path

    from cuvee.schema import RAW_SCHEMA
    from cuvee.sources import reviews as source

    monkeypatch.setattr(source, "PACKED_RECORDS", 4)
    raw = [(i, "Italy", 'two\nlines, "said" ' * 50, "d", 90, 1.5, "p", "r", "s", "t", "@t", f"title {i}", "v", "w") for i in range(10)]
    df = spark.createDataFrame(raw, RAW_SCHEMA).repartition(1)
    write_reviews_csv(df, folder + "/csv", compression="gzip")
    files = list(Path(folder, "csv").glob("*.csv.gz"))
    assert len(files) == 3
    assert sum(f.stat().st_size for f in files) < sum(len(gzip.decompress(f.read_bytes())) for f in files) / 3
    assert sorted(map(tuple, read_reviews_csv(spark, folder + "/csv").collect())) == sorted(map(tuple, df.collect()))
