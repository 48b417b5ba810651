"""Write, audit, publish: a version becomes current only if every rule holds."""

import pytest
from pyspark.sql import functions as F

from jobloom.operators import publish as pb, quality as qa, requirements as rq
from jobloom.plans import publication as pn
from tests.test_sources import TODAY, landed

VOCABULARY = rq.Vocabulary([rq.Entry("sql", "SQL", ("SQL",), "skill")])


def payload(n, **extra):
    text = "Requisitos: SQL. " + "texto " * 30
    return {"data": [{"id": i, "name": f"Analista de Dados {i}", "careerPageName": "Acme", "jobUrl": f"http://g/{i}", "city": "Recife", "publishedDate": "2026-08-10", "description": text, **extra} for i in range(n)]}


def run(spark, path, rows, **options):
    return pn.refresh_and_publish(spark, landed(spark, "gupy", rows), path, TODAY.cast("date"), "gupy", vocabulary=VOCABULARY, **options)


def test_refresh_publishes_and_a_refused_one_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "public")
    first = run(spark, path, payload(3))
    assert pb.current(spark, f"{path}/snapshot") == first["snapshot"] and pb.current(spark, f"{path}/index") == first["index"]
    assert pb.read_current(spark, f"{path}/snapshot", "jobs").count() == 3
    header = pb.read_current(spark, f"{path}/snapshot", "header").first()
    assert (header["count"], header["schema_version"], header["max_age_months"], header["collected_source_counts"]) == (3, 3, 2, {"gupy": 3})
    assert {r["url"] for r in pb.read_current(spark, f"{path}/index", "entries").collect()} == {f"https://g/{i}" for i in range(3)}
    assert "description" not in pb.read_current(spark, f"{path}/index", "entries").columns

    for rows, options, reason in (
        (payload(4, name="<script>alert(1)</script>"), {}, "script_in_title"),
        (payload(4), {"minimum": 5}, "minimum_rows"),
        (payload(4), {"cap_mb": 0.0001}, "jobs_too_large"),
    ):
        with pytest.raises(qa.QualityError, match=reason):
            run(spark, path, rows, **options)
        for part in ("history", "snapshot", "index"):
            assert pb.current(spark, f"{path}/{part}") == first[part]

    second = run(spark, path, payload(5))
    assert second["snapshot"] != first["snapshot"] and pb.read_current(spark, f"{path}/snapshot", "jobs").count() == 5
    listed = pb.publications(spark, f"{path}/snapshot").filter("part = 'jobs'").orderBy("published_at").collect()
    assert [(r["version"], r["rows"]) for r in listed] == [(first["snapshot"], 3), (second["snapshot"], 5)]


def test_half_a_catalog_does_not_replace_a_whole_one(spark, tmp_path):
    path = str(tmp_path / "public")
    lever = [{"id": f"z{i}", "text": "Analista de Dados", "hostedUrl": f"https://l/z{i}", "categories": {"location": "Recife, Brazil"}, "createdAt": 1786000000000} for i in range(2)]
    both = landed(spark, "gupy", payload(3)).unionByName(landed(spark, "lever", lever, board="acme"))
    today = TODAY.cast("date")
    pn.refresh_and_publish(spark, both, path, today, "gupy,lever")
    assert pb.read_current(spark, f"{path}/snapshot", "jobs").count() == 5
    expected = spark.createDataFrame([("gupy", 3, None, None, None), ("lever", 1, 2, 1, 1)], "source string, minimum int, reported int, pages_got int, pages_total int")
    short = landed(spark, "gupy", payload(1)).unionByName(landed(spark, "lever", lever, board="acme"))
    pn.refresh_and_publish(spark, short, path, today, "gupy,lever", expectations=expected)
    assert pb.read_current(spark, f"{path}/snapshot", "jobs").count() == 5
    assert pb.read_current(spark, f"{path}/snapshot", "header").first()["failed_sources"] == ["gupy"]


def test_row_rules_are_counted_while_rows_are_written(spark, tmp_path):
    rows = spark.range(1000).repartition(7).withColumn("text", F.concat(F.lit("t"), F.col("id") % 10))
    part = pb.Part("p", rows, {"low": F.count_if(F.col("id") < 30)}, key="text", required=("id", "other"), forbidden=("text",), allowed=("id",))
    audit = pb.write_version(spark, str(tmp_path / "v"), [part])
    assert audit.violations == {"low": 30, "p_repeated_text": 990, "p_missing_columns": 1, "p_private_columns": 1, "p_unknown_columns": 1}
    assert audit.figures["p"] == {"rows": 1000, "bytes": sum(len(f'{{"id":{i},"text":"t{i % 10}"}}') for i in range(1000))}
    with pytest.raises(qa.QualityError):
        pb.publish(audit)
    assert pb.current(spark, str(tmp_path / "v")) is None


def test_empty_parts_hold(spark, tmp_path):
    audit = pb.write_version(spark, str(tmp_path / "v"), [pb.Part("p", spark.range(0), {"r": F.count_if(F.col("id") > 0)}, key="id", cap_mb=1)])
    assert set(audit.violations.values()) == {0} and audit.figures["p"] == {"rows": 0, "bytes": 0}
    pb.publish(audit)
    assert pb.read_current(spark, str(tmp_path / "v"), "p").count() == 0


def test_index_and_staging_rules(spark, tmp_path):
    terms = spark.createDataFrame([(0, "SQL"), (1, "x" * 81), (2, "call +55 (81) 9 9999-0000"), (3, "a@b.co"), (4, "w " * 13)], "code int, label string")
    entry = "url string, m array<int>, p array<int>, c array<int>, x array<int>, q int, t string"
    entries = spark.createDataFrame([("https://a", [0], [], [], [], 95, "T"), ("http://b", [5], [-1], [], [], 101, "Description"), ("https://a", [], [], [], [], None, "t" * 181)], entry)
    found = pn.write_packed(spark, str(tmp_path / "i"), terms, entries).violations
    bad = {k: v for k, v in found.items() if v}
    assert bad == {"term_too_long": 1, "term_personal_data": 2, "term_many_words": 1, "entry_link": 1, "confidence_range": 1, "code_range": 1, "metadata_t": 2, "entries_repeated_url": 1}

    good = {"id": "1", "company": "c", "title": "t", "category": "k", "seniority": "s", "workplaceType": "Remoto", "location": "l", "url": "https://a.inhire.app/vagas/1"}
    rows = spark.createDataFrame([good]).withColumns({"contractTypes": F.array(F.lit("CLT")), "alerts": F.array().cast("array<string>"), "detailFetchedAt": F.lit("")})
    header = pn.staging_header(rows, F.lit("2026-08-10T10:00:00Z"))
    assert set(pn.write_staging(spark, str(tmp_path / "s"), rows, header).violations.values()) == {0}
    broken = pn.write_staging(spark, str(tmp_path / "t"), rows.unionByName(rows), header.withColumn("collected_at", F.lit("?"))).violations
    assert {k for k, v in broken.items() if v} == {"jobs_repeated_id", "total_jobs", "collected_at", "workplace_sum"}
