import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from palate.functions.numbers import round_half_even, whole_days
from palate.functions.quantiles import exact_quantiles
from palate.functions.sampling import dense_index, hash_sample, seeded_hash
from palate.functions.text import price_level, strip, words


@pytest.mark.parametrize("size", [0, 1, 37, 300, 2999, 3000, 5000])
def test_hash_sample_takes_the_smallest_hashes(spark, size):
    df = spark.range(3000)
    expected = df.orderBy(seeded_hash(F.col("id"), 7), "id").limit(size)
    assert rows(hash_sample(df, "id", size, 7)) == rows(expected)


def test_hash_sample_takes_a_scalar_size(spark):
    df = spark.range(200)
    quota = df.agg(F.floor(F.count(F.lit(1)) * F.lit(0.15)).cast("long")).scalar()
    assert hash_sample(df, "id", quota, 1).count() == 30


def test_dense_index_numbers_every_group_without_gaps(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7))
    got = dense_index(df, "id", "ix", ("g",)).groupBy("g").agg(
        F.min("ix").alias("lo"), F.max("ix").alias("hi"), F.count_distinct("ix").alias("n"), F.count("*").alias("m"))
    for r in got.collect():
        assert (r.lo, r.hi + 1, r.n) == (0, r.m, r.m)


@pytest.mark.parametrize("width", [0.5, 10.0, 1e6])
def test_exact_quantiles_match_numpy(spark, width):
    values = [float(x) for x in np.random.default_rng(3).integers(-50, 400, 777)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    fractions = (0.0, 0.25, 0.5, 0.7, 0.85, 1.0)
    got = exact_quantiles(df, F.col("v"), fractions, width).first()
    assert np.allclose(list(got), np.quantile(values, fractions))


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), F.col("v"), (0.5,), 1.0).first().q0 is None


def test_whole_days_floors_elapsed_time(spark):
    df = spark.sql("SELECT timestamp'2020-01-01 23:00:00' AS a, timestamp'2020-01-02 01:00:00' AS b")
    assert rows(df.select(whole_days(F.col("b"), F.col("a")), whole_days(F.col("a"), F.col("b")))) == [(0, -1)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a b\n ",)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == "a b"
    prices = spark.createDataFrame([("'2'",), ("2.7",), ("u'2'",), (None,), ("nan",), (" \"3\" ",)], "p string")
    assert [r[0] for r in prices.select(price_level(F.col("p"))).collect()] == [2, 2, None, None, None, 3]
    assert spark.range(1).select(words(F.lit("Ça va? It's \u00a0O.K."))).first()[0] == ["a", "va", "its", "", "ok"]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.25,), (0.75,), (-0.25,)], "x double")
    assert [r[0] for r in df.select(round_half_even(F.col("x"), 1)).collect()] == [0.2, 0.8, -0.2]


def test_crowded_cells_are_cut_until_small(spark, monkeypatch):
    """Nine tenths of the values crowd into a thousandth of the range: no task orders more than CELL_VALUES of them."""
    from palate.functions import quantiles

    monkeypatch.setattr(quantiles, "CELL_VALUES", 20)
    rng = np.random.default_rng(9)
    values = np.concatenate([rng.random(900), 1000 * rng.random(100)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    fractions = (0.0, 0.1, 0.5, 0.899, 0.95, 1.0)
    assert np.allclose(list(exact_quantiles(df, F.col("v"), fractions, 1000.0).first()), np.quantile(values, fractions))


def test_ordered_index_numbers_rows_in_order(spark):
    from palate.functions.sampling import ordered_index
    data = [(i, (i * 7919) % 13) for i in range(500)]  # few values, many ties
    df = spark.createDataFrame(data, "id long, volume long").repartition(5)
    got = {r.id: r.place for r in ordered_index(df, [F.desc("volume"), F.asc("id")], "place").collect()}
    assert got == {i: n for n, (i, _) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])), 1)}
    assert ordered_index(df.limit(0), [F.asc("id")], "place").count() == 0
