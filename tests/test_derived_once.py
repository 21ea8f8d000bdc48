"""Queries that read a derived table in several jobs derive it once."""

from cinelake.operators import eda as E
from cinelake.operators.neighbors import similar_by_genre
from cinelake.plans import q_eda, q_popularity
from cinelake.sources import tables as S


def counted(spark, rows, schema):
    """A frame and a counter of the rows that were derived for it."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return spark.createDataFrame(rows, schema).repartition(2).mapInArrow(run, schema), seen


RATINGS = [(u, m, float(1 + (u * m) % 5)) for u in range(1, 7) for m in range(1, 9) if (u + m) % 3]
SCHEMA = "userId long, movieId long, rating double"


def test_standardize_reads_its_ratings_once(spark, monkeypatch):
    ratings, seen = counted(spark, RATINGS, SCHEMA)
    monkeypatch.setattr(S, "interactions", lambda *_: ratings)
    got = {r.userId: r for r in q_eda.q_standardize(spark, "").collect()}
    assert len(got) == 6 and abs(sum(r.u_mean_z for r in got.values())) < 1e-9
    assert seen.value == len(RATINGS)


def test_profile_table_reads_its_rows_once(spark):
    rows = [*RATINGS, (1, None, None), (9, 3, 2.5)]
    df, seen = counted(spark, rows, SCHEMA)
    got = {r.column_name: r for r in E.profile_table(df, "t").collect()}
    assert seen.value == len(rows)
    assert (got["userId"]["count"], got["userId"].nulls, got["userId"].distinct) == (len(rows), 0, 7)
    assert (got["rating"]["count"], got["rating"].nulls, got["rating"].distinct) == (len(rows) - 1, 1, len({r[2] for r in rows} - {None}))
    movies = sorted(r[1] for r in rows if r[1] is not None)
    assert got["movieId"].p50 == (movies[(len(movies) - 1) // 2] + movies[len(movies) // 2]) / 2


def test_unseen_onboarding_reads_its_ratings_once(spark, monkeypatch):
    ratings, seen = counted(spark, [(*r, r[1]) for r in RATINGS], SCHEMA + ", ts long")
    movies = spark.createDataFrame([(m, f"T{m}", "A|B" if m % 2 else "C") for m in range(1, 20)], "movieId long, title string, genres string")
    monkeypatch.setattr(S, "interactions", lambda *_: ratings)
    monkeypatch.setattr(S, "movies", lambda *_: movies)
    got = q_popularity.q_genre_onboarding_unseen(spark, "").collect()
    assert {r.req_id for r in got} == set(range(1, 7)) and not {(r.req_id, r.movieId) for r in got} & {r[:2] for r in RATINGS}
    assert seen.value == len(RATINGS)


def test_genre_affinity_is_bounded_by_a_task_and_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(E, "AFFINITY_ROWS", 5)
    rows = [*RATINGS, (1, 99, 4.0)]                                   # 99: no movie, but a rating of user 1
    movies = [(m, "A|B" if m % 2 else "C") for m in range(1, 9)] + [(8, "C")]
    df = E.genre_affinity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(movies, "movieId long, genres string"))
    want = {}
    for u, m, r in rows:
        for _, gs in (x for x in movies if x[0] == m):
            for g in gs.split("|"):
                want[u, g] = want.get((u, g), 0.0) + (r - 2.5) / sum(x[0] == u for x in rows)
    assert {(r.userId, r.genre): round(r.affinity, 9) for r in df.collect()} == {k: round(v, 9) for k, v in want.items()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_similar_by_genre_sorts_no_seed(spark):
    movies = [(m, "A|B" if m % 2 else "C") for m in range(1, 30)] + [(29, "A|B"), (4, "A")]      # 4 and 29: two rows
    df = similar_by_genre(spark.createDataFrame(movies, "movieId long, genres string"), 5)
    got = {}
    for r in df.collect():
        got.setdefault(r.seed, []).append((r["rank"], r.movieId, r.sim))
    assert sorted(got) == list(range(1, 30)) and all(sorted(x[0] for x in v) == [1, 2, 3, 4, 5] for v in got.values())
    assert [x[1] for x in sorted(got[1])] == [3, 5, 7, 9, 11] and [x[1] for x in sorted(got[6])] == [2, 4, 8, 10, 12]
