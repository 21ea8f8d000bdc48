"""CSV files in the published dialect, as the standard library writes them."""

import csv

import pytest
from pyspark.sql import functions as F

from cinelake.sources import tables as S

TITLES = ['"Great Performances" Cats (1998)', 'say "hi", now', "line one\nline two (1999)", "back\\slash, (2000)", 'ends with \\"', "plain (2001)",
          "", " spaced ", 'a,"b",c', '""', "Ünï 中文 (1987)"]


def write(path, header, rows, raw=()):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)
        f.writelines(x + "\n" for x in raw)


def test_movies(spark, tmp_path):
    rows = [(i, t, "Action|Drama") for i, t in enumerate(TITLES)]
    write(tmp_path / "movies.csv", ["movieId", "title", "genres"], rows, ["x1,bad id,Drama", '12,"too few"', "13,too,many,fields"])
    got = sorted(tuple(r) for r in S.load_movies_csv(spark, str(tmp_path)).collect())
    assert got == [(i, t or None, g) for i, t, g in rows]
    bad = sorted(r.record for r in S.quarantined_csv(spark, str(tmp_path), "movies").collect())
    assert bad == ['12,"too few"', "13,too,many,fields", "x1,bad id,Drama"]


def test_a_bad_field_counts_whatever_is_read(spark, tmp_path):
    write(tmp_path / "ratings.csv", ["userId", "movieId", "rating", "timestamp"], [(1, 2, 3.5, 100), (2, 3, 4.0, 200)], ["3,4,four,300", "5,6,1.0,soon"])
    r = S.load_ratings_csv(spark, str(tmp_path))
    assert r.count() == 2 and r.select("userId").distinct().count() == 2
    assert r.groupBy("movieId").count().count() == 2
    assert r.select(F.sum("rating")).first()[0] == 7.5
    assert [str(x.ts) for x in r.orderBy("userId").collect()] == ["1970-01-01 00:01:40", "1970-01-01 00:03:20"]
    assert S.quarantined_csv(spark, str(tmp_path), "ratings").count() == 2


def test_tags(spark, tmp_path):
    tags = ['He said "go", twice', "new\nline", "", "sci-fi", " Sci-Fi "]
    write(tmp_path / "tags.csv", ["userId", "movieId", "tag", "timestamp"], [(i, 10, t, i) for i, t in enumerate(tags)], ["9,10,late,never"])
    got = sorted((r.userId, r.tag) for r in S.load_tags_csv(spark, f"file://{tmp_path}").collect())
    assert got == [(i, t or None) for i, t in enumerate(tags)]


def test_links_and_round_trip(spark, tmp_path):
    write(tmp_path / "links.csv", ["movieId", "imdbId", "tmdbId"], [(1, 2, 3.0), (2, 3, "")], ["a,b,c"])
    assert sorted(tuple(r) for r in S.load_links_csv(spark, str(tmp_path)).collect()) == [(1, 2, 3.0), (2, 3, None)]
    df = spark.createDataFrame([(i, t or None, None if i % 2 else "x") for i, t in enumerate(TITLES)], S.MOVIES_SCHEMA)
    S.write_csv(df, str(tmp_path / "out"), "movies")
    assert sorted(S.load_movies_csv(spark, str(tmp_path / "out")).collect()) == sorted(df.collect())


def test_empty_files(spark, tmp_path):
    write(tmp_path / "movies.csv", ["movieId", "title", "genres"], [])
    assert S.load_movies_csv(spark, str(tmp_path)).count() == 0 and S.quarantined_csv(spark, str(tmp_path), "movies").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.load_tags_csv(spark, str(tmp_path)).count()
