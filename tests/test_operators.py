import pytest
from pyspark.sql import functions as F

from jobloom.operators import classify, dedupe, filters as fl, history as hi, ordering as od, quality as qa, sinks
from jobloom.operators.search import csv_rows
from jobloom.schema import JOB, as_canonical

TODAY = F.lit("2026-08-20").cast("date")


def jobs(spark, *rows):
    names = ["source", "native_id", "work_model", "city", "country", "market"]
    frame = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} string" for n in names))
    frame = frame.withColumns({"title": F.concat(F.lit("Vaga "), "native_id"), "company": F.lit("Empresa"), "url": F.concat(F.lit("https://e/"), "native_id")})
    return as_canonical(frame)


def stored(spark, *rows, today=TODAY):
    batch = classify.with_classes(jobs(spark, *rows))
    empty = spark.createDataFrame([], hi.HISTORY)
    return hi.merge(empty, hi.as_history_rows(batch), today)


def test_work_model_is_filled_only_for_blank_brazilian_rows(spark):
    rows = jobs(spark, ("a", "1", "", "Brasil", "BR", "BR"), ("b", "2", "", "São Paulo", "BR", "BR"), ("c", "3", "hybrid", "Recife", "BR", "BR"), ("d", "4", "", "", "US", "BR"))
    got = {r["native_id"]: (r["work_model"], r["filled"]) for r in fl.with_inferred_work_model(rows, "filled").collect()}
    assert got == {"1": ("remote", True), "2": ("on-site", True), "3": ("hybrid", False), "4": ("", False)}


def test_upsert_keeps_known_work_model_and_first_sighting(spark):
    first = stored(spark, ("p", "1", "remote", "Brasil", "BR", "BR"), today=F.lit("2026-08-01"))
    batch = hi.as_history_rows(classify.with_classes(jobs(spark, ("p", "1", "", "Olinda", "BR", "BR"), ("p", "2", "", "Curitiba", "BR", "BR"))))
    merged = hi.merge(first, batch, TODAY, change="change")
    rows = {r["job_uid"]: r for r in merged.collect()}
    assert rows["p:1"]["work_model"] == "remote" and rows["p:1"]["city"] == "Olinda"
    assert (rows["p:1"]["first_seen_date"], rows["p:1"]["last_seen_date"]) == ("2026-08-01", "2026-08-20")
    assert (rows["p:1"]["change"], rows["p:2"]["change"]) == ("updated", "inserted")
    repaired = {r["job_uid"]: r["work_model"] for r in hi.repair_work_models(merged.drop("change")).collect()}
    assert repaired["p:2"] == "on-site"


def test_upsert_is_idempotent(spark):
    batch = hi.as_history_rows(classify.with_classes(jobs(spark, ("p", "1", "", "Recife", "BR", "BR"))))
    once = hi.merge(spark.createDataFrame([], hi.HISTORY), batch, TODAY)
    twice = hi.merge(once, batch, TODAY)
    assert once.collect() == twice.collect()


def test_purges(spark):
    table = stored(spark, ("totvs", "1", "", "X", "BR", "BR"), ("totvs", "2", "", "X", "BR", "BR"), ("greenhouse", "3", "", "Lisboa", "", "BR"), ("greenhouse", "4", "", "Recife", "", "BR"))
    listed = spark.createDataFrame([("totvs:1",)], "job_uid string")
    assert {r[0] for r in hi.purge_absent(table, "totvs", listed).select("job_uid").collect()} == {"totvs:1", "greenhouse:3", "greenhouse:4"}
    assert hi.purge_absent(table, "totvs", listed.limit(0)).count() == 4
    assert {r[0] for r in hi.purge_foreign(table, "greenhouse", listed).select("job_uid").collect()} == {"totvs:1", "totvs:2", "greenhouse:4"}


def test_prune_treats_missing_market_as_unknown(spark):
    table = stored(spark, ("greenhouse", "1", "", "Recife", "", None), ("gupy", "2", "", "Recife", "", "BR"))
    table = table.withColumn("market", F.when(F.col("source") != "greenhouse", F.col("market")))
    assert [r[0] for r in hi.prune(table, TODAY).select("job_uid").collect()] == ["gupy:2"]


def test_keep_first_and_keep_last(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "k string, o int, v string")
    assert sorted(map(tuple, dedupe.keep_last(rows, ["k"], ["o"], "first").collect())) == [("a", 3, "z", 1), ("b", 2, "y", 2)]
    assert sorted(map(tuple, dedupe.keep_first(rows, ["k"], ["o"]).collect())) == [("a", 1, "x"), ("b", 2, "y")]


def test_hot_keys_do_not_change_portal_counts(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("job_uid"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1500).cast("string")).alias("dedupe_key"),
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("source"))
    got = dedupe.with_portals(rows)
    expected = rows.join(rows.groupBy("dedupe_key").agg(F.countDistinct("source").alias("want")), "dedupe_key")
    assert got.count() == 3000
    assert got.join(expected.select("job_uid", "want"), "job_uid").filter("portals <> want").count() == 0


def test_codes_in_ranges_are_dense_and_ordered(spark):
    rows = spark.range(5000).select((F.col("id") * 7 % 5000).alias("o"), (F.col("id") % 3).alias("t"))
    got = od.codes_in_ranges(rows, "o", ["t"], ranges=13).orderBy("code").collect()
    assert [r["code"] for r in got] == list(range(5000)) and [r["o"] for r in got] == list(range(5000))


def test_top_rows_equals_plain_sort(spark):
    rows = spark.range(2000).select(F.col("id"), F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 9 + 1).cast("string"), 2, "0")).alias("d"))
    order = [F.desc("d"), F.asc("id")]
    assert od.top_rows(rows, order, 300, F.col("d")).collect() == rows.orderBy(*order).limit(300).collect()


def test_page_number_is_clamped(spark):
    rows = spark.range(50)
    assert [r[0] for r in od.page(rows, [F.asc("id")], 99).collect()] == [48, 49]
    assert [r[0] for r in od.page(rows, [F.asc("id")], -3).collect()] == list(range(24))
    days = rows.withColumn("day", F.floor(F.col("id") / 7))
    for number in (1, 2, 3, 99):
        order = [F.desc("day"), F.asc("id")]
        plain = [r[0] for r in od.page(days, order, number, 9).collect()]
        assert plain == [r[0] for r in od.page(days, order, number, 9, coarse=F.col("day")).collect()] and plain
    assert od.page(days.limit(0), order, 2, 9, coarse=F.col("day")).count() == 0


def test_union_keeps_registry_order_and_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    rows = od.in_registry_order([a, b], ["first", "last"]).orderBy("registry_ord").collect()
    assert [(r["registry_name"], r["x"], r["y"]) for r in rows] == [("first", 1, None), ("last", 2, "q")]


def test_classification_with_the_default_vocabulary(spark):
    data = [("Analista de Dados Sênior", "", []), ("Estágio em Marketing", "", []), ("Gerente de Vendas", "", []), ("x", "", ["Sales"]), ("Pessoa Desenvolvedora", "python java react", []), ("x", "", [])]
    rows = spark.createDataFrame([("s", str(i), t, d, c) for i, (t, d, c) in enumerate(data)], "source string, native_id string, title string, description string, categories array<string>")
    got = [(r["area"], r["seniority"]) for r in classify.with_classes(as_canonical(rows)).orderBy("native_id").collect()]
    assert got == [
        ("Dados, BI e IA", "Sênior/Especialista"), ("Marketing e Comunicação", "Estágio"), ("Comercial e Vendas", "Liderança"),
        ("Comercial e Vendas", "Não informado"), ("TI e Desenvolvimento", "Não informado"), ("Outros", "Não informado")]


def test_staging_rules(one):
    title = lambda v: F.lit(v)
    assert one(classify.staging_category(title("Analista de Suporte")), classify.staging_seniority(title("Coordenador Sênior")),
               classify.language_level(F.lit("Inglês nível avançado")), classify.staging_workplace(F.lit("Home Office")),
               classify.stated_modality(F.lit("Modelo de trabalho: presencial"))) == (
        "Suporte, Atendimento e CS", "Liderança", "Avançado/fluente", "Remoto", "Presencial")
    alerts = classify.contradiction_alerts(F.lit("Dev remoto"), F.lit("Recife"), F.lit(""), F.lit("Presencial"), F.lit(False))
    assert one(alerts) == ["O título indica remoto, mas a plataforma classifica como presencial", "Os detalhes não foram recuperados nesta atualização"]


def test_alerts_read_whole_texts(spark, tmp_path):
    """a modality counts wherever the text names it, in the operator, in cls_07 and in its SQL; cls_06 reads 12,000 characters, as its SQL does."""
    duckdb = pytest.importorskip("duckdb")
    from jobloom.plans import load_queries

    late = [f"{gap * 9_000} modelo de trabalho: presencial" for gap in ("x ", "é ", "x\n", "\u0301 x")] + ["trabalho presencial " + "x " * 60_000 + "modelo hybrid", "x " * 9_000]
    rows = spark.createDataFrame([*enumerate(late)], "i int, t string")
    assert [r["m"] for r in rows.select("i", classify.stated_modality(F.col("t")).alias("m")).orderBy("i").collect()] == ["Presencial"] * 4 + ["Híbrido", ""]
    assert [r["m"] for r in rows.select("i", classify.stated_modality(F.col("t"), chars=12_000).alias("m")).orderBy("i").collect()] == [""] * 4 + ["Presencial", ""]
    alerts = classify.contradiction_alerts(F.col("t"), F.lit("Brasil"), F.col("t"), F.lit("Remoto"), F.lit(True), title_chars=None)
    assert [len(r["a"]) for r in rows.select("i", alerts.alias("a")).orderBy("i").collect()] == [2] * 5 + [0]

    texts = ["x " * 9_000 + "the end of", "é " * 9_000 + "los que", "les que " + "x " * 9_000 + "der und", "the of", None]
    documents = spark.createDataFrame([(3 * i + k, t) for i, t in enumerate(texts) for k in range(3)], "doc_id long, text string")
    documents.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found, oracle = load_queries()
    got = {name: sorted(tuple(r) for r in found[name](spark, str(tmp_path)).collect()) for name in ("cls_06_stated_modality", "cls_07_contradiction_alerts")}
    assert all(rows == sorted(con.execute(oracle[name]).fetchall()) for name, rows in got.items())
    said = dict(got["cls_07_contradiction_alerts"])
    assert [said[3 * i].count("híbrido") for i in range(5)] == [2, 0, 2, 2, 0] and said[3].count("presencial") == 2
    assert [r[1] for r in got["cls_06_stated_modality"]] == [""] * 6 + ["Presencial"] * 3 + ["Híbrido"] * 3 + [""] * 3


def test_quality_report_and_guard(spark):
    rows = spark.createDataFrame([("http://x", "T"), ("https://x", "<SCRIPT>")], "url string, title string")
    rows = rows.withColumns({"source": F.lit("s"), "country": F.lit("BR"), "pub": F.lit("2026-08-01"), "exp": F.lit("")})
    report = qa.violations(rows, qa.snapshot_rules(TODAY, minimum=3))
    assert {r["rule"]: r["violations"] for r in report.collect()} == {
        "minimum_rows": 1, "https_link": 1, "older_than_cutoff": 0, "autozone_abroad": 0, "script_in_title": 1}
    with pytest.raises(qa.QualityError):
        qa.require(report)
    with pytest.raises(sinks.SizeGuardError):
        sinks.guard_size(rows, 0.00001, "rows")


def test_csv_document(spark, tmp_path):
    blank = {c: F.lit("") for c in ("sourceLabel", "category", "seniority", "workplaceType", "market", "location", "publishedAt", "lastSeenAt", "url", "currency")}
    rows = spark.createDataFrame([("=T", 'A "B"', ["CLT", "PJ"], True)], "title string, company string, contractTypes array<string>, pcd boolean")
    rows = rows.withColumns({**blank, "blindSelection": F.lit(False), "salaryMin": F.lit(10.0), "salaryMax": F.lit(None).cast("double")})
    sinks.write_csv(csv_rows(rows), str(tmp_path / "csv"))
    text = "".join(p.read_bytes().decode() for p in sorted((tmp_path / "csv").glob("part-*")))
    lines = text.split("\r\n")
    assert lines[0].startswith('﻿"Cargo";"Empresa"') and lines[1].startswith('"\'=T";"A ""B""";') and '"CLT | PJ";"Sim";"Não"' in lines[1]


def test_canonical_fields_cover_the_schema(spark):
    row = as_canonical(spark.createDataFrame([("s", " T ")], "source string, title string")).first()
    assert row["title"] == "T" and row["skills"] == [] and row["pcd"] is False and row["salary_min"] is None and list(row.asDict()) == JOB.fieldNames()


# ---------------------------------------------------------------- stored text search, vocabulary, orders


def test_indexed_search_reads_little_and_finds_all(spark, tmp_path, monkeypatch):
    from jobloom.operators import text_search as ts

    monkeypatch.setattr(ts, "CHUNK", 50)
    texts = [f"vaga {i} de {'analista' if i % 3 else 'piloto'} {'xilofone' if i in (7, 311) else ''} é" for i in range(400)] + [None, "", "ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "position long, _search string").repartition(5)
    path = str(tmp_path / "search")
    ts.build(rows, path)
    for wanted in ("xilofone", "analista", "vaga 31", "é", "ab", "zzz", "piloto xilofone", "", "aaa"):
        got = sorted(r["position"] for r in ts.indexed_search(spark, path, wanted).collect())
        assert got == [i for i, t in enumerate(texts) if t is not None and wanted in t], wanted
    met, most = ts.candidates(spark, path, "xilofone")
    assert most == 2 and sorted(r["key"] for r in met.collect()) == [7, 311] and met.select("chunk").distinct().count() == 2
    assert ts.indexed_search(spark, path, "analista", F.col("position") < 10).count() == 6
    plan = ts.indexed_search(spark, path, "xilofone")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan  # other folders are not read


def test_vocabulary_of_any_size_equals_patterns(spark):
    import random
    import re

    from jobloom.operators.text_search import vocabulary_hits

    rnd = random.Random(4)
    words = ["sql", "pl/sql", "c++", "java", "javascript", "node.js", "go", "dados", "ciencia de dados", "dado", "r", "a.b"]
    texts = [" ".join(rnd.choice([*words, "x", "sqlx", "/sql"]) for _ in range(rnd.randint(0, 8))) for _ in range(150)] + [None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    terms = spark.createDataFrame([(w,) for w in [*words, "", "go"]], "term string")

    def plain(text, term):
        if len(term) > 4 and not re.search(r"[.#+/-]", term):
            return term in text
        left = "a-z0-9/" if term == "sql" else "a-z0-9"
        return re.search(rf"(?<![{left}]){re.escape(term)}(?![a-z0-9])", text) is not None

    want = sorted((i, w) for i, t in enumerate(texts) if t is not None for w in words if plain(t, w))
    for shard in (5, 1000):
        assert sorted(map(tuple, vocabulary_hits(rows, terms, "t", shard=shard).collect())) == want


def test_numbers_compare_by_value_and_places_have_no_gaps(spark):
    from jobloom.functions.text import collation_key
    from jobloom.operators.ordering import places

    names = ["vaga 10", "Vaga 9", "vága 009", "vaga", "Vaga 10b", "vaga 1000000000000000000000", "10 vagas", "9 vagas", "", "vaga x"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").repartition(4)
    got = [r["n"] for r in places(rows, [collation_key("n"), F.col("i")], "at").orderBy("at").collect()]
    assert got == ["", "9 vagas", "10 vagas", "vaga", "Vaga 9", "vága 009", "vaga 10", "Vaga 10b", "vaga 1000000000000000000000", "vaga x"]
    many = spark.range(5000).repartition(7).withColumn("g", F.col("id") % 3)
    placed = places(many, [F.desc("id")], "at", group="g").collect()
    for g in range(3):
        assert [r["id"] for r in sorted((r for r in placed if r["g"] == g), key=lambda r: r["at"])] == [i for i in range(4999, -1, -1) if i % 3 == g]
        assert sorted(r["at"] for r in placed if r["g"] == g) == list(range(sum(1 for i in range(5000) if i % 3 == g)))
