"""Cleaning, raw readers and the feature table."""

from pyspark.sql import functions as F

from ratewise.functions.text import GENRES, genre_slug, release_year
from ratewise.operators import clean as C
from ratewise.operators.features import feature_table, movie_dimension
from ratewise.sources.delimited import read_movies, read_ratings, read_users

RATINGS = [(61, 410, 2, 7200), (61, 420, 5, 7260), (62, 410, 11, 7300), (62, 420, -1, 7350), (62, 420, 1, 7400)]
MOVIES = [(410, "Salt Road (1974)", "Western|Romance"), (420, "Night Ferry (2019)", "Thriller")]
USERS = [(61, "F", 50, 7, "04109"), (62, "M", 18, 4, "80331"), (62, "M", 18, 4, "80331")]


def _frames(spark):
    r = spark.createDataFrame(RATINGS, "user_id int, movie_id int, rating int, timestamp long")
    m = spark.createDataFrame(MOVIES, "movie_id int, title string, genres string")
    u = spark.createDataFrame(USERS, "user_id int, gender string, age int, occupation int, zip_code string")
    return r, m, u


def test_rating_range_and_unique_pairs(spark):
    r, _, _ = _frames(spark)
    clean, seen_in, seen_out = C.clean_ratings(r)
    rows = sorted(tuple(x) for x in clean.collect())
    assert rows == [(61, 410, 2, 7200), (61, 420, 5, 7260), (62, 420, 1, 7400)]
    assert seen_in.get["rows"] == 5 and seen_out.get["rows"] == 3


def test_dedupe_keeps_earliest(spark):
    r = spark.createDataFrame([(1, 5, 2, 300), (1, 5, 4, 100), (1, 5, 3, 200)],
                              "user_id int, movie_id int, rating int, timestamp long")
    clean, _, _ = C.clean_ratings(r)
    assert [tuple(x) for x in clean.collect()] == [(1, 5, 4, 100)]


def test_release_year_and_genre_flags(spark):
    _, m, _ = _frames(spark)
    dim = movie_dimension(C.clean_movies(m)).orderBy("movie_id").collect()
    assert dim[0]["release_year"] == 1974 and dim[1]["release_year"] == 2019
    assert (dim[0]["genre_western"], dim[0]["genre_romance"], dim[0]["genre_thriller"]) == (1, 1, 0)
    assert dim[1]["genre_thriller"] == 1
    assert genre_slug("Children's") == "genre_childrens" and genre_slug("Film-Noir") == "genre_film_noir"


def test_release_year_absent_and_genre_exact_token(spark):
    df = spark.createDataFrame([("No Year",), ("Odd (1999) Title",), ("Spaces (1984)  ",)], "title string")
    got = [r[0] for r in df.select(release_year("title")).collect()]
    assert got == [None, None, 1984]
    g = spark.createDataFrame([("Dramatic|Action",)], "genres string")
    flags = movie_dimension(g.withColumn("title", F.lit("x")).withColumn("movie_id", F.lit(1))).first()
    assert flags["genre_drama"] == 0 and flags["genre_action"] == 1


def test_user_dedupe(spark):
    _, _, u = _frames(spark)
    assert C.clean_users(u).count() == 2


def test_feature_table_complete(spark):
    r, m, u = _frames(spark)
    clean, _, _ = C.clean_ratings(r)
    ft = feature_table(clean, movie_dimension(C.clean_movies(m)), C.clean_users(u))
    assert len(ft.columns) == 34
    assert C.null_audit(ft).first()["null_cells"] == 0
    row = ft.filter("user_id = 61 AND movie_id = 410").first()
    assert row["movie_rating_count"] == 1 and row["user_rating_count"] == 2
    assert row["rating_year"] == 1970 and row["release_year"] == 1974
    assert set(genre_slug(g) for g in GENRES) <= set(ft.columns)


def test_raw_readers(spark, scratch):
    ratings = "1::10::5::1000\n1::20::3::1001\n\n2::x::4::1002\n3::10\n"
    with open(f"{scratch}/ratings.dat", "w") as f:
        f.write(ratings)
    movies = ('10::Amélie (2001)::Comedy|Romance\n20::Crouching, Tiger (2000)::Action\n'
              '30::"Quoted" Title (1995)::Drama\n40::No Year Here::Drama\n')
    with open(f"{scratch}/movies.dat", "wb") as f:
        f.write(movies.encode("iso-8859-1"))
    with open(f"{scratch}/users.dat", "w") as f:
        f.write("1::M::25::1::12345\n2::F::35::2::67890\n")
    r = read_ratings(spark, f"{scratch}/ratings.dat")
    assert r.count() == 4  # blank line skipped
    assert C.drop_incomplete(r).count() == 2  # non-numeric and short lines -> NULL -> dropped
    mv = {x["movie_id"]: x for x in read_movies(spark, f"{scratch}/movies.dat").collect()}
    assert mv[10]["title"] == "Amélie (2001)"
    assert mv[20]["title"] == "Crouching, Tiger (2000)"
    assert mv[30]["title"] == '"Quoted" Title (1995)'
    years = {x["movie_id"]: x["y"] for x in read_movies(spark, f"{scratch}/movies.dat")
             .select("movie_id", release_year("title").alias("y")).collect()}
    assert years == {10: 2001, 20: 2000, 30: 1995, 40: None}
    assert read_users(spark, f"{scratch}/users.dat").count() == 2


def test_audit_counts_one_pass(spark):
    r, _, _ = _frames(spark)
    clean, _, _ = C.clean_ratings(r)
    audit = C.audit_counts("ratings", r, [("in_range", F.col("rating").between(1, 5))], final=clean)
    got = [(x["stage"], x["rows"]) for x in audit.orderBy("step").collect()]
    assert got == [("raw", 5), ("in_range", 3), ("deduplicated", 3)]
