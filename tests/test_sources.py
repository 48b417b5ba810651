import json

import pytest
from pyspark.sql import functions as F

from jobloom.plans import refresh as rf
from jobloom.sources import cards, embedded, feeds, json_specs, markup, tables

TODAY = F.lit("2026-08-20")


def landed(spark, source, body, board=None, url="https://x.example/a"):
    body = body if isinstance(body, str) else json.dumps(body)
    return spark.createDataFrame([(source, board, 1, url, body)], json_specs.LANDED)


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_badge_card(spark):
    page = """<div class="vaga-card" data-href="vaga_emprego/vaga-faroleira-77.php"><h3 class="vaga-titulo">Faroleira de Dados</h3>
      <span class="vaga-empresa-nome">Maré Alta</span><div class="vaga-local-linha">Olinda • PE</div><p class="vaga-resumo-linha">PJ • Sênior • Híbrido</p>
      <p class="vaga-meta-extra">Oceanos • ontem</p><time datetime="2026-07-02T08:15:00-03:00"></time><a class="hashtag">#ondas</a></div> Página 1 de 1"""
    row = only(markup.rows(landed(spark, "nerdin", page), "nerdin", TODAY))
    assert (row["source"], row["native_id"], row["work_model"], row["contract_types"], row["state"]) == ("Nerdin", "77", "hybrid", ["PJ"], "PE")
    assert row["published_date"] == "2026-07-02T08:15:00-03:00" and row["skills"] == ["ondas"] and row["categories"] == ["Oceanos", "#ondas"]


def test_listing_cards(spark):
    rows = spark.createDataFrame(
        [("https://i/vaga-de-emprego-remador__41.aspx?x=1", "Remador", "Remador\nHoje\nMaré Alta\nNiterói - RJ\nPresencial\nCLT"),
         ("https://i/vaga-de-emprego-cartografa__42.aspx", "Cartógrafa", "Cartógrafa\nOntem\nMaré Alta\nTodo Brasil\nCLT"),
         ("https://i/empregos.aspx", "x", "y")], "href string, title string, text string")
    got = {r["native_id"]: r for r in cards.normalize_cards(rows, TODAY).collect()}
    assert set(got) == {"41", "42"}
    assert (got["41"]["work_model"], got["41"]["city"], got["41"]["state"], got["41"]["company"]) == ("on-site", "Niterói", "RJ", "Maré Alta")
    assert (got["42"]["work_model"], got["42"]["city"], got["42"]["published_date"]) == ("", "", "2026-08-19")


def test_documents_with_references(spark):
    item = {"id": "7", "attributes": {"title": "Dev", "country": "Brasil", "initial_salary_range": "1000,50", "promote_company": False, "work_type": [{"name": "Híbrido"}], "slug": "dev a"},
            "relationships": {"level_of_interest": {"data": {"type": "l", "id": 1}}, "area_of_interests": {"data": [{"type": "a", "id": "2"}, {"type": "a", "id": "9"}]}}}
    body = {"data": [item, {"id": "8", "attributes": {"title": "x", "country": "Chile"}}], "included": [{"type": "l", "id": "1", "attributes": {"name": "Pleno"}}, {"type": "a", "id": "2", "attributes": {"title": "TI"}}]}
    row = only(json_specs.rows(landed(spark, "abler", body), "abler"))
    assert (row["levels"], row["categories"], row["salary_min"], row["salary_currency"], row["work_model"], row["blind_selection"]) == (["Pleno"], ["TI"], 1000.5, "BRL", "hybrid", True)
    assert row["url"].endswith("?slug=dev%20a") and row["company"] == "Agência Team"


def test_portal_mappings(spark):
    rows = lambda source, body, **kw: json_specs.rows(landed(spark, source, body, **kw), source)
    r = only(rows("empregare", {"model": {"dados": [{"id": 1, "titulo": "A", "cidades": ["Recife, PE, BR"], "tags": [{"tag": "x"}, "y"], "salario": "R$ 1.000,00", "pcd": "Sim"}]}}))
    assert (r["city"], r["skills"], r["salary_min"], r["pcd"], r["url"]) == ("Recife, PE, BR", ["x", "y"], 1000.0, True, "https://www.empregare.com/v1")
    r = only(rows("solides", {"data": {"data": [{"id": 5, "title": "Ação", "salary": {"showRangeToApplicant": True, "type": "simple", "finalRange": 900}, "city": {"name": "Recife"}, "state": {"code": "PE"}, "homeOffice": True}]}}))
    assert (r["salary_min"], r["salary_max"], r["city"], r["work_model"], r["url"]) == (900.0, None, "Recife, PE", "remote", "https://vagas.solides.com.br/vaga/5/acao")
    oracle = {"items": [{"TotalJobsCount": 2, "requisitionList": {"items": [
        {"Id": 1, "Title": "Dev", "PrimaryLocation": "SAO PAULO, SP, Brasil", "PrimaryLocationCountry": "br", "secondaryLocations": {"items": [{"LocationName": "Recife, PE"}]}},
        {"Id": 2, "Title": "Abroad", "PrimaryLocation": "Austin, TX", "PrimaryLocationCountry": "US"}]}}]}
    r = only(rows("autozone", oracle))
    assert (r["city"], r["market"], r["url"][-7:]) == ("São Paulo, SP · Recife, PE", "BR", "1/job/1")
    assert rows("dell", oracle).count() == 2
    r = only(rows("accenture", {"data": [{"guid": "9_pt-br", "country": "Brasil", "title": "T", "location": ["Brasil", "Recife"], "jobTypeDescription": "Mid-Level", "jobDetailUrl": "https://www.accenture.com/{0}/careers/jobdetails?id=9"}]}))
    assert (r["native_id"], r["work_model"], r["city"], r["levels"]) == ("9", "on-site", "Recife", ["Pleno"])
    r = only(rows("bradesco", {"data": {"requisitions": [{"requisitionId": 3, "title": "T", "locations": [{"city": "Austin", "country": "US"}, {"city": "Osasco", "state": "SP", "country": "BR"}], "postedDate": "05/03/2024"}, {"id": 4, "title": "T", "location": "Lisboa"}]}}))
    assert (r["city"], r["state"], r["published_date"]) == ("Osasco", "SP", "2024-03-05")
    r = only(rows("github", [{"number": 3, "title": "Dev", "labels": [{"name": "CLT"}, {"name": "Remoto"}]}, {"number": 4, "title": "x", "pull_request": {}} | {"pull_request": {"u": 1}}], board="org/vagas"))
    assert (r["native_id"], r["company"], r["contract_types"], r["work_model"]) == ("org/vagas#3", "org", ["CLT"], "remote")
    r = only(rows("stone", {"jobs": [{"id": 1, "title": "Dev | Porto Alegre / RS", "location": {"name": "Remoto"}, "metadata": [{"name": "Tipo de contrato:", "value": ["CLT", "PJ"]}]}]}))
    assert (r["contract_types"], r["work_model"]) == (["CLT", "PJ"], "remote")
    r = only(rows("lever", [{"id": "a", "text": "T", "categories": {"location": "São Paulo", "team": "Eng"}}], board="ciandt"))
    assert (r["company"], r["market"], r["categories"]) == ("CI&T", "BR", ["Eng"])
    assert rows("lever", [{"id": str(i), "text": "T"} for i in range(130)], board="b").count() == 120
    r = only(rows("jobicy", {"jobs": [{"id": 1, "jobTitle": "A", "jobIndustry": "Dev"}, {"id": 1, "jobTitle": "B"}]}))
    assert (r["title"], r["categories"]) == ("A", ["Dev"])
    r = only(rows("remoteok", [{"legal": "x"}, {"id": "0", "position": "P", "salary_min": 0, "salary_max": 10}]))
    assert (r["native_id"], r["salary_min"], r["salary_max"], r["salary_currency"]) == ("0", None, 10.0, "USD")


def test_embedded_payloads(spark):
    chunk = lambda text: f"<script>self.__next_f.push({json.dumps([1, text])})</script>"
    stream = '0:{"data":[1]}1:{"data":[{"id":5,"__typename":"PublicJob","atsJob":{"jobSlug":"dev","company":{"slug":"acme-1"},"atsJobDetail":{"title":"Dev","atsJobSalaries":[{"minSalary":10,"maxSalary":30,"currency":"BRL","contractType":"PJ"},{"minSalary":5}]}}}],"meta":{"lastPage":2}}'
    page = landed(spark, "geekhunter", chunk(stream[:40]) + chunk(stream[40:]))
    row = only(rf.source_rows(page, "geekhunter", TODAY))
    assert (row["native_id"], row["company"], row["salary_min"], row["salary_max"], row["contract_types"]) == ("5", "Acme", 5.0, 30.0, ["PJ"])
    page = landed(spark, "fiserv", 'x phApp.ddo = {"eagerLoadRefineSearch":{"data":{"jobs":[{"jobId":"1","title":"A B","country":"Brazil"}]}}}; phApp.z')
    assert only(rf.source_rows(page, "fiserv", TODAY))["url"] == "https://careers.fiserv.com/us/en/job/1/a-b"
    page = landed(spark, "revolut", '<script id="__NEXT_DATA__">{"props":{"pageProps":{"positions":[{"id":"i","text":"A (B)","locations":[{"country":"Brazil","type":"office","name":"Rio"}]}]}}}</script>')
    assert only(rf.source_rows(page, "revolut", TODAY))["city"] == "Rio"
    page = landed(spark, "inlog", 'vagas\\":[{\\"id\\":3,\\"Titulo_vaga\\":\\"T\\"}],\\"empresaNome')
    assert only(rf.source_rows(page, "inlog", TODAY))["title"] == "T"
    assert embedded.script_data(F.lit("none")) is not None


def test_feed(spark):
    body = "<rss><channel><item><title>Acme: Dev: Sr</title><link>https://a</link><pubDate>Tue, 05 Mar 2024 10:11:12 +0000</pubDate><region>World</region></item><item><title>Solo</title><link>https://b</link></item></channel></rss>"
    got = {r["url"]: r for r in feeds.rows(landed(spark, "weworkremotely", body)).collect()}
    assert (got["https://a"]["company"], got["https://a"]["title"], got["https://b"]["company"], got["https://b"]["title"]) == ("Acme", "Dev: Sr", "", "Solo")


def test_other_card_portals(spark):
    rows = lambda source, body, **kw: markup.rows(landed(spark, source, body, **kw), source, TODAY)
    r = only(rows("experian", '<a class="t" href="/job/dev-in-sp-jid-42"><b>Dev</b> Sr</a><a href="/job/dev-in-sp-jid-42">More info</a>'))
    assert (r["native_id"], r["title"], r["url"]) == ("42", "Dev Sr", "https://jobs.experian.com/job/dev-in-sp-jid-42")
    r = only(rows("recrutei", '<a href="/rehva-tech/vacancy/77-dev"><h3>Dev</h3><span>CLT ou PJ</span><p>Remoto</p></a>', board="rehva-tech"))
    assert (r["native_id"], r["company"], r["contract_types"], r["work_model"]) == ("rehva-tech:77", "Rehva Tech", ["CLT", "PJ"], "remote")
    card = '<div class="x index__job-opportunities__grid__item" data-title="Dev PCD" data-city-name="Recife" data-state-small-name="pe"><div><a data-cy="job-opportunity-link" href="/vidya/12/dev">Dev</a></div></div>'
    r = only(rows("totvs", card, board="vidya"))
    assert (r["native_id"], r["city"], r["state"], r["pcd"], r["company"]) == ("vidya:12", "Recife", "PE", True, "Vidya")
    detail = markup.catalog_details(landed(spark, "totvs", '<p class="job-opportunity__subtitle">Híbrido | Olinda - PE</p><div data-cy="mobile-regime">CLT</div>')).first()
    assert (detail["work_model"], detail["city"], detail["state"], detail["contract_types"]) == ("hybrid", "Olinda", "PE", ["CLT"])
    r = only(rows("metalfrio", '<a class="card card-vacancy z" href="/Detail/9"><h3 title="Op &amp; X"></h3><div class="icon-location-pin-1"></div> Recife - PE <i class="vacancy-date">5 set</i></a>'))
    assert (r["title"], r["city"], r["state"], r["published_date"], r["work_model"]) == ("Op & X", "Recife", "PE", "2025-09-05", "on-site")
    r = only(rows("nestle", '<tr class="data-row"><td><a href="/job/x/55/" class="jobTitle-link">Nespresso Dev</a></td><td class="colLocation">Recife, BR</td><td class="colDate">Mar 5, 2024</td></tr>'))
    assert (r["native_id"], r["company"], r["city"], r["published_date"]) == ("55", "Nespresso", "Recife", "2024-03-05")
    r = only(rows("dbccompany", '<a href="/vagas/dev-7?x=1">Dev Remoto</a>'))
    assert (r["native_id"], r["work_model"]) == ("dev-7", "remote")
    r = only(rows("cloudwalk", '<div class="jobs-list-cms-position"><div class="is-open-position">Dev</div><div fs-list-field="location-type">Remote</div><div fs-list-field="location">Recife</div><a href="/jobs-positions/dev">go</a>'))
    assert (r["native_id"], r["city"], r["work_model"]) == ("dev", "Recife", "remote")


def test_readers_check_shapes(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text("﻿" + json.dumps([{"id": "t:1", "title": "T", "location": "Recife, PE, BR"}]), encoding="utf-8")
    bad.write_text("{}", encoding="utf-8")
    assert only(json_specs.rows(tables.staging_payload(spark, str(good)), "inhire"))["state"] == "PE"
    with pytest.raises(tables.SourceShapeError):
        tables.staging_payload(spark, str(bad))
    taxonomy = tmp_path / "t.json"
    taxonomy.write_text(json.dumps({"schema_version": 1, "entries": [{"id": "a", "label": "A", "aliases": ["Á", "b"], "kind": "skill"}]}), encoding="utf-8")
    assert [r["alias_folded"] for r in tables.taxonomy_aliases(tables.read_taxonomy(spark, str(taxonomy))).collect()] == ["a", "b"]
    taxonomy.write_text(json.dumps({"schema_version": 2, "entries": []}))
    with pytest.raises(tables.SourceShapeError):
        tables.read_taxonomy(spark, str(taxonomy))


def test_refresh_end_to_end(spark):
    gupy = {"data": [{"id": i, "name": f"Analista de Dados {i}", "careerPageName": "Acme", "jobUrl": f"http://g/{i}", "city": "Recife", "publishedDate": "2026-08-10", "description": "Requisitos: SQL. " + "texto " * 30} for i in range(3)]}
    lever = [{"id": "z", "text": "Analista de Dados", "hostedUrl": "https://l/z", "categories": {"location": "Austin"}, "createdAt": 1755000000000}]
    both = landed(spark, "gupy", gupy).unionByName(landed(spark, "lever", lever, board="acme"))
    from jobloom.schema import HISTORY

    out = rf.refresh(spark, both, spark.createDataFrame([], HISTORY), TODAY.cast("date"), sources="gupy,lever")
    assert {r["source"]: r["jobs"] for r in out.counts.collect()} == {"gupy": 3}
    assert "description" not in out.batch.columns and "description" not in out.history.columns
    from jobloom.operators.requirements import Entry, Vocabulary

    index = rf.requirement_index(out.collected, out.batch, Vocabulary([Entry("sql", "SQL", ("SQL",), "skill")]))
    assert sorted(r["url"] for r in index.collect()) == ["https://g/0", "https://g/1", "https://g/2"]
    assert out.changes.first()["inserted"] == 3
    shown = out.snapshot.encoded().collect()
    assert len(shown) == 3 and all(r["url"].startswith("https://") for r in shown) and {r["wm"] for r in shown} == {0}
    with pytest.raises(ValueError):
        rf.refresh(spark, both, spark.createDataFrame([], HISTORY), TODAY.cast("date"), sources="nope")
