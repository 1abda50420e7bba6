import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from checks.common import view
from palate.operators.candidates import confidence_matrix
from palate.operators.descriptive import city_summary
from palate.operators.features import cohort_users, enrich_businesses, user_features
from palate.session import scratch_path, shared_dir
from palate.sources import jsonl
from palate.sources.artifacts import read_artifact, read_report, write_artifact, write_bucketed, write_report
from palate.streaming.ingest import append_interactions, stream_cohort_reviews


def write_lines(path, records):
    path.write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    return str(path)


def test_business_loader_coerces_and_reads_attributes(spark, tmp_path):
    path = write_lines(tmp_path / "b.json", [
        {"business_id": "x", "stars": 4.5, "review_count": "7", "attributes": {"A": "True", "B": "{'c': 1}"}, "is_open": 1},
        {"business_id": "y", "stars": "n/a", "review_count": None, "attributes": None},
    ])
    got = {r.business_id: r for r in jsonl.load_businesses(spark, path).collect()}
    assert (got["x"].stars, got["x"].review_count, got["x"].attributes["B"]) == (4.5, 7.0, "{'c': 1}")
    assert (got["y"].stars, got["y"].review_count, got["y"].attributes) == (None, None, None)
    assert jsonl.load_businesses(spark, path, n=1).first().business_id == "x"


def test_user_loader_renames_the_signup_field(spark, tmp_path):
    path = write_lines(tmp_path / "u.json", [
        {"user_id": "u", "joined": "2019-02-03 04:05:06", "elite": "2019", "fans": 3, "compliment_hot": 2},
        {"user_id": "v", "joined": "?", "elite": None}])
    got = jsonl.load_users(spark, path, signup_field="joined").orderBy("user_id").collect()
    assert str(got[0].signup_date) == "2019-02-03 04:05:06" and got[1].signup_date is None
    assert [r.is_elite for r in got] == [True, False] and got[0].compliment_hot == 2.0


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        jsonl.load_tips(spark, str(tmp_path / "nowhere.json"))


def test_artifacts_prune_partitions(spark):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string")
    path = write_artifact(df, scratch_path(spark, "test"), ("split",))
    test = read_artifact(spark, path).where("split = 'test'")
    assert rows(test, "id") == [(2,)]
    assert len(test.inputFiles()) == 2 and "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().toString()


def test_reports_round_trip(spark):
    df = spark.createDataFrame([("b", "x", 4.0, 2.0)], "business_id string, city string, stars double, review_count double")
    path = write_report(city_summary(df), scratch_path(spark, "report"))
    assert rows(read_report(spark, path, "city string, business_count long, avg_stars double, total_reviews double")) == [("x", 1, 4.0, 2.0)]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    record = {"review_id": "1", "user_id": "u", "business_id": "b", "stars": "4", "date": "2020-01-01 00:00:00", "text": "abc", "useful": 1}
    write_lines(drop / "1.json", [record, {**record, "business_id": "other"}])
    kept = spark.createDataFrame([("b",)], "business_id string")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for expected in (1, 1, 2):
        if expected == 2:
            write_lines(drop / "2.json", [{**record, "text": "abcd"}])
        append_interactions(stream_cohort_reviews(spark, str(drop), kept), out, state).awaitTermination(120)
        assert spark.read.parquet(out).count() == expected
    assert rows(spark.read.parquet(out), "review_len", "useful") == [(3, 1), (4, 1)]


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured


def test_bucketed_interactions_are_grouped_without_exchange(spark, sf_dir, capsys):
    history = view(spark, sf_dir, "interactions")
    businesses, users = enrich_businesses(view(spark, sf_dir, "businesses")), view(spark, sf_dir, "users")
    targets = history.select("user_id").distinct()
    bucketed = write_bucketed(history, "bucketed_interactions", scratch_path(spark, "bucketed"), "user_id", 4)
    try:
        def jobs(rows):
            return confidence_matrix(rows), user_features(rows, businesses, cohort_users(users, targets), only=targets)

        for plain, kept in zip(jobs(history), jobs(bucketed)):
            capsys.readouterr()
            kept.explain()
            exchanges = [line for line in capsys.readouterr().out.splitlines() if "hashpartitioning(user_id" in line]
            plain.explain()
            before = [line for line in capsys.readouterr().out.splitlines() if "hashpartitioning(user_id" in line]
            assert len(exchanges) < len(before), (exchanges, before)
            columns = [c for c in plain.columns if plain.schema[c].dataType.simpleString() != "double"]
            assert plain.count() == kept.count() and plain.select(columns).exceptAll(kept.select(columns)).isEmpty()
            assert kept.columns != ["user_id", "business_id", "confidence"] or not exchanges
    finally:
        spark.sql("DROP TABLE bucketed_interactions")
