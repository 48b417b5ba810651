"""Landed JSON payloads to canonical rows: one declarative mapping per portal.

A landed row is one response: ``source, board, page, url, body``.  A spec says where the items are, how an item maps
to canonical columns, which items are kept and which repeat wins.  Everything is a projection plus one aggregate per
source; items are never collected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobloom import fixed_values as fx
from jobloom.functions import arrays as ar, dates as dt, numbers as nu, text as tx
from jobloom.operators.classify import market_of_place, multiplicity_place, multiplicity_work_model
from jobloom.operators.dedupe import keep_first, keep_last
from jobloom.operators.filters import names_brazil
from jobloom.schema import JOB, canonical
from jobloom.sources.json_items import Item, as_text, elements, entry_name, field, is_object, location_text, metadata_values

LANDED = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("board", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Spec:
    items: str  # path of the list in the payload; blank when the payload is the list
    map: Callable[[Item], dict[str, Column]]
    keep: Callable[[Item], Column] | None = None
    repeats: str = "all"  # which row of a repeated identifier wins: all, first, last
    first_items: int | None = None  # items taken per payload


def _dot(*columns: Column) -> Column:
    return F.array_join(ar.trimmed(F.array(*columns)), " · ")


def _spaced(*columns: Column) -> Column:
    return F.concat_ws(" ", *columns)


def _br(**more: Column) -> dict[str, Column]:
    return {"country": F.lit("BR"), "market": F.lit("BR"), **more}


# ---------------------------------------------------------------- national portals


def _inhire(i: Item) -> dict[str, Column]:
    place = i.text("location")
    parts = tx.split_location(place)
    return {
        "native_id": i.first("id", "url"), "title": i.text("title"), "company": i.text("company"), "url": i.text("url"),
        "work_model": tx.work_model(i.text("workplaceType")), "city": place, "state": parts["state"],
        # the code in the location wins; a location naming Brazil and one naming nothing both mean BR
        "country": F.coalesce(F.nullif(parts["country"], F.lit("")), F.lit("BR")), "market": F.lit("BR"),
        "published_date": dt.iso_date(i.first("lastPublishedAt", "publishedAt", "updatedAt")),
        "contract_types": F.filter(F.transform(i.elements("contractTypes"), as_text), lambda v: v != ""),
        "levels": ar.singleton(i.text("seniority")), "categories": ar.singleton(i.text("category")),
    }


def _empregare(i: Item) -> dict[str, Column]:
    places = ar.trimmed(F.transform(i.elements("cidades"), as_text))
    parts = tx.split_location(F.coalesce(F.get(places, F.lit(0)), F.lit("")))
    tags = i.names("tags", "tag", "nome", distinct=False)
    pay = nu.money(i.text("salario"))
    return {
        "native_id": i.text("id"), "title": i.text("titulo"), "company": i.text("empresa"),
        "url": F.concat(F.lit("https://www.empregare.com/v"), i.text("id")),
        "work_model": tx.work_model(i.first("trabalhoRemotoTexto", "trabalhoRemoto")),
        "city": tx.first_non_blank(F.array_join(ar.first_n(places, 3), " · "), parts["city"]),
        "state": parts["state"], "country": parts["country"], "market": F.lit("BR"),
        "salary_min": pay["low"], "salary_max": pay["high"], "salary_currency": pay["currency"],
        "published_date": dt.iso_date(i.first("dataCadastro", "timestamp")), "expires_date": dt.iso_date(i.text("dataExpiracao")),
        "skills": ar.first_n(tags, 8), "description": i.text("chamada"), "levels": ar.singleton(i.text("nivel")),
        "categories": tags, "pcd": nu.is_true_text(i.text("pcd")), "blind_selection": nu.is_true_text(i.text("recrutamentoCego")),
    }


def _gupy(i: Item) -> dict[str, Column]:
    return _br(
        native_id=i.text("id"), title=i.text("name"), company=i.text("careerPageName"), url=i.text("jobUrl"),
        work_model=tx.work_model(i.text("workplaceType"), i.truthy("isRemoteWork")), city=i.text("city"), state=i.text("state"),
        published_date=dt.iso_date(i.text("publishedDate")), expires_date=dt.iso_date(i.text("applicationDeadline")),
        skills=F.filter(F.transform(i.elements("skills"), lambda e: entry_name(e, "name")), lambda v: v != ""),
        description=tx.strip_html(i.text("description")),
    )


def _gupy_page(i: Item) -> dict[str, Column]:
    base = F.regexp_replace("url", "/+$", "")
    return _br(
        native_id=i.text("id"), title=i.text("title"), company=F.col("page_company"),
        url=F.concat(base, F.lit("/jobs/"), i.text("id"), F.lit("?jobBoardSource=gupy_public_page")),
        work_model=tx.work_model(i.text("workplace.workplaceType")), city=i.text("workplace.address.city"),
        state=i.text("workplace.address.state"), categories=F.array(tx.strip(i.text("department"))),
    )


def _solides(i: Item) -> dict[str, Column]:
    place = lambda leaf: i.first(f"city.{leaf}", f"address.city.{leaf}")
    # a top-level state object hides the one in the address
    own_state = i.truthy("state")
    state = tx.strip(F.when(own_state, i.first("state.code", "state.name")).otherwise(i.first("address.state.code", "address.state.name")))
    city = tx.strip(F.when(i.truthy("city"), i.text("city.name")).otherwise(place("name")))
    country = tx.strip(F.coalesce(F.nullif(i.first("address.country.code", "address.country.name"), F.lit("")), F.lit("BR")))
    home = F.upper(country).isin("BR", "BRASIL", "BRAZIL")
    pay = nu.visible_salary(
        i.truthy("salary.showRangeToApplicant"), i.text("salary.type"), i.number("salary.initialRange"), i.number("salary.finalRange")
    )
    raw_model = F.coalesce(F.nullif(i.text("jobType"), F.lit("")), F.when(i.truthy("homeOffice"), "remoto"), F.lit(""))
    any_flag = i.truthy("pcdOnly") | i.truthy("peopleWithDisabilities") | i.truthy("hasSpecialNeeds")
    link = F.concat(F.lit("https://vagas.solides.com.br/vaga/"), tx.percent_encode(tx.strip(i.text("id"))), F.lit("/"), tx.title_slug(i.text("title")))
    return {
        "native_id": i.text("id"), "title": i.text("title"), "company": i.text("companyName"), "url": link,
        "work_model": tx.work_model(raw_model, i.is_true("homeOffice")),
        "city": F.concat_ws(", ", F.nullif(city, F.lit("")), F.nullif(state, F.lit(""))), "state": state,
        "country": F.when(home, "BR").otherwise(country), "market": F.when(home, "BR").otherwise("Global"),
        "salary_min": pay["low"], "salary_max": pay["high"], "salary_currency": pay["currency"],
        "published_date": dt.iso_date(i.text("createdAt")), "skills": ar.first_n(i.names("hardSkills", "name", distinct=False), 10),
        "description": tx.strip_html(i.text("description")), "levels": i.names("seniority", "name", distinct=False),
        "categories": i.names("occupationAreas", "name", distinct=False),
        "contract_types": i.names("recruitmentContractType", "name", distinct=False),
        "pcd": any_flag, "blind_selection": i.truthy("isHiddenJob"),
    }


def _geekhunter(i: Item) -> dict[str, Column]:
    detail = "atsJob.atsJobDetail."
    slug, job_slug = tx.strip(i.text("atsJob.company.slug")), tx.strip(i.text("atsJob.jobSlug"))
    model = tx.work_model(i.text(detail + "workModality"))
    cities = i.elements(detail + "atsJobCities")
    places = ar.trimmed(F.transform(cities, lambda e: F.coalesce(F.nullif(as_text(field(e, "name")), F.lit("")), as_text(field(e, "city.name")))))
    codes = ar.trimmed(F.transform(cities, lambda e: F.upper(as_text(field(e, "city.countryCode")))))
    first_parts = ar.trimmed(F.split(F.coalesce(F.get(places, F.lit(0)), F.lit("")), ","))
    tail = F.get(first_parts, F.size(first_parts) - 1)
    state = F.when((F.size(first_parts) >= 2) & (F.length(tail) <= 3), F.upper(tail)).otherwise("")
    shown = F.array_join(F.array_distinct(ar.first_n(places, 3)), " · ")
    pays = i.elements(detail + "atsJobSalaries")
    amounts = lambda name: F.array_compact(F.transform(pays, lambda e: F.try_variant_get(e, f"$.{name}", "double")))
    lows, highs = amounts("minSalary"), amounts("maxSalary")
    currencies = F.filter(F.transform(pays, lambda e: as_text(field(e, "currency"))), lambda v: v != "")
    any_pay = (F.size(lows) > 0) | (F.size(highs) > 0)
    skills = F.transform(i.elements(detail + "atsJobSkills"), lambda e: F.coalesce(
        F.when(is_object(field(e, "atsSkill")), as_text(field(e, "atsSkill.name"))), as_text(field(e, "poolSkill.name"))))
    description = tx.strip_html(i.text(detail + "description"))
    return {
        "native_id": i.first("id", "atsJob.id"), "title": i.text(detail + "title"), "company": tx.company_from_slug(slug),
        "url": F.concat(F.lit("https://www.geekhunter.com/pt/"), slug, F.lit("/jobs/"), job_slug), "work_model": model,
        "city": F.when((shown == "") & (model == "remote"), "Remoto").otherwise(shown), "state": state,
        "country": F.coalesce(F.get(codes, F.lit(0)), F.when(state != "", "BR"), F.lit("")), "market": F.lit("BR"),
        "salary_min": F.array_min(lows), "salary_max": F.array_max(highs),
        "salary_currency": F.when(any_pay, F.get(currencies, F.lit(0))),
        "published_date": dt.epoch_date(i.first("atsJob.publishedAt", "atsJob.firstCreatedAt")),
        "skills": ar.first_n(ar.trimmed_distinct(skills), 12), "description": description,
        "levels": ar.singleton(i.text(detail + "experienceLevel")),
        "contract_types": ar.trimmed_distinct(F.transform(pays, lambda e: as_text(field(e, "contractType")))),
        "pcd": tx.matches(_spaced(i.text(detail + "title"), description), r"(?iu)\bpcd\b|pessoa(?:s)? com defici"),
        "blind_selection": slug.isin(*fx.CONFIDENTIAL_SLUGS),
    }


def _abler(i: Item) -> dict[str, Column]:
    a = "attributes."
    model = F.array_join(
        F.when(i.truthy(a + "work_type"), i.names(a + "work_type")).otherwise(i.names(a + "work_type_formatted")), " "
    )
    low = nu.tolerant_number(i.first(a + "initial_salary_range", a + "salary_value", a + "salary"))
    high = nu.tolerant_number(i.text(a + "final_salary_range"))
    slug = tx.strip(i.text(a + "slug"))
    listed = "https://ats.abler.com.br/jobs/ag%C3%AAnciateam-6047?slug="
    # relationship targets sit in the ``included`` list of the same response
    included = elements(F.col("included"))

    def related(name: str) -> Column:
        data = i.raw(f"relationships.{name}.data")
        references = F.when(is_object(data), F.array(data)).otherwise(elements(data))
        found = F.transform(references, lambda r: F.get(
            F.reverse(F.filter(included, lambda e: (as_text(field(e, "type")) == as_text(field(r, "type"))) & (as_text(field(e, "id")) == as_text(field(r, "id"))))), F.lit(0)))
        return ar.trimmed_distinct(F.transform(found, lambda e: entry_name(field(e, "attributes"), "name", "title")))

    levels = related("level_of_interest")
    described = F.concat_ws(" ", *[i.text(a + f) for f in (
        "role_description", "mandatory_requirements", "desirable_requirements", "results_and_deliveries", "working_journey")])
    return _br(
        native_id=i.text("id"), title=i.first(a + "title_formatted", a + "title"),
        company=F.coalesce(F.nullif(i.text(a + "company_name"), F.lit("")), F.lit("Agência Team")),
        url=F.when(slug != "", F.concat(F.lit(listed), tx.percent_encode(slug))).otherwise(
            F.concat(F.lit("https://candidatos.abler.com.br/vagas?slug=abler-"), tx.percent_encode(i.text("id")))),
        work_model=tx.work_model(model, i.is_true(a + "available_for_homeoffice")),
        city=tx.strip(i.text(a + "city")), state=tx.strip(i.text(a + "state")), salary_min=low, salary_max=high,
        salary_currency=F.when(low.isNotNull() | high.isNotNull(), "BRL"),
        published_date=dt.iso_date(i.first(a + "republished_at", a + "published_at", a + "created_at")),
        expires_date=dt.iso_date(i.text(a + "close_on")),
        skills=ar.first_n(F.concat(i.names(a + "tech_skills"), i.names(a + "soft_skills")), 10),
        description=tx.strip_html(tx.first_non_blank(i.text(a + "description"), described)),
        levels=F.when(F.size(levels) > 0, levels).otherwise(ar.singleton(tx.strip(i.text(a + "seniority_level_formatted")))),
        categories=related("area_of_interests"), contract_types=ar.singleton(tx.strip(i.text(a + "contracting_regime"))),
        pcd=i.truthy(a + "exclusive_pcd"), blind_selection=i.is_false(a + "promote_company"),
    )


def _abler_keep(i: Item) -> Column:
    home = F.upper(tx.strip(i.text("attributes.country"))).isin(*fx.BRAZIL_COUNTRY_CODES)
    return home & i.truthy("id") & (tx.strip(i.first("attributes.title_formatted", "attributes.title")) != "")


def _accenture(i: Item) -> dict[str, Column]:
    places = i.values("location")
    model = multiplicity_work_model(places)
    description = tx.strip_html(_spaced(i.text("jobDescriptionClean"), i.text("qualificationClean"), i.text("additionalInformation")))
    level = tx.strip(i.text("jobTypeDescription"))
    title = tx.strip(i.text("title"))
    return _br(
        native_id=F.coalesce(F.nullif(i.text("requisitionId"), F.lit("")), F.regexp_replace(tx.strip(i.text("guid")), "_pt-br$", "")),
        title=title, company=F.lit("Accenture"), url=F.replace(i.text("jobDetailUrl"), F.lit("{0}"), F.lit("br-pt")),
        work_model=model, city=multiplicity_place(places, model), published_date=dt.iso_date(i.text("updateDate")),
        skills=ar.first_n(ar.ordered_union(i.values("skill"), i.values("mustHaveSkills"), i.values("goodToHaveSkills")), 12),
        description=description, levels=ar.singleton(F.coalesce(tx.lookup(fx.ACCENTURE_LEVELS, F.lower(level)), level)),
        categories=ar.ordered_union(i.values("jobFamilyGroup"), i.values("businessArea"), i.values("function")),
        pcd=tx.matches(_spaced(title, F.substring(description, 1, 1000)), fx.PCD_TEXT),
    )


def _accenture_keep(i: Item) -> Column:
    link = F.replace(i.text("jobDetailUrl"), F.lit("{0}"), F.lit("br-pt"))
    return (
        (F.lower(tx.strip(i.text("country"))) == "brasil")
        & tx.strip(i.text("guid")).endswith("_pt-br")
        & link.startswith("https://www.accenture.com/br-pt/careers/jobdetails")
    )


_BRADESCO_TITLE = ("displayJobTitle", "postingTitle", "title", "requisitionTitle", "jobTitle")
_BRADESCO_ID = ("requisitionId", "requisitionID", "id", "jobId")


def _bradesco_place(i: Item) -> tuple[Column, Column, Column, Column]:
    """Location value, its objects, their country codes, the first Brazilian object."""
    value = F.coalesce(*[F.when(i.text(p) != "", i.raw(p)) for p in ("locations", "location", "locationName")])
    objects = F.when(is_object(value), F.array(value)).otherwise(F.filter(elements(value), is_object))
    country = lambda e: tx.strip(F.coalesce(*[F.nullif(as_text(field(e, k)), F.lit("")) for k in ("country", "countryCode", "countryName")], F.lit("")))
    coded = F.exists(objects, lambda e: country(e) != "")
    home = F.filter(objects, lambda e: F.upper(country(e)).isin(*fx.BRAZIL_COUNTRY_CODES))
    return value, objects, coded, home


def _bradesco(i: Item) -> dict[str, Column]:
    value, objects, coded, home = _bradesco_place(i)
    place = location_text(value)
    primary = F.get(F.when(coded, home).otherwise(objects), F.lit(0))
    parts = tx.split_location(place)
    description = tx.strip_html(i.first("externalDescription", "description", "jobDescription"))
    title, native = i.first(*_BRADESCO_TITLE), i.first(*_BRADESCO_ID)
    everything = _spaced(title, description, place)

    def date(*names: str) -> Column:
        raw = i.first(*names)
        return tx.first_non_blank(dt.iso_date(raw), dt.slash_date(raw))

    named = tx.strip(F.coalesce(*[F.nullif(as_text(field(primary, k)), F.lit("")) for k in ("city", "locationName", "name")], F.lit("")))
    return _br(
        native_id=native, title=title, company=F.lit("Bradesco"),
        url=F.concat(F.lit("https://bradesco.csod.com/ux/ats/careersite/1/home/requisition/"), native, F.lit("?c=bradesco")),
        work_model=tx.work_model(everything),
        city=F.when(primary.isNotNull(), named).otherwise(parts["city"]),
        state=F.when(primary.isNotNull(), tx.strip(as_text(field(primary, "state")))).otherwise(parts["state"]),
        published_date=date("postingEffectiveDate", "postedDate", "postingDate", "datePosted"),
        expires_date=date("postingExpirationDate", "closingDate", "expirationDate", "endDate"), description=description,
        categories=ar.singleton(i.first("category", "jobCategory", "jobFamily")), pcd=tx.matches(everything, fx.PCD_TEXT_SHORT),
    )


def _bradesco_keep(i: Item) -> Column:
    value, _, coded, home = _bradesco_place(i)
    place = location_text(value)
    here = F.when(coded, F.size(home) > 0).otherwise((place == "") | names_brazil(place))
    return (i.first(*_BRADESCO_ID) != "") & (i.first(*_BRADESCO_TITLE) != "") & here


def _github(i: Item) -> dict[str, Column]:
    labels = i.names("labels", "name", distinct=False)
    place, title = F.array_join(labels, " · "), tx.strip(i.text("title"))
    return _br(
        native_id=F.concat(F.col("board"), F.lit("#"), i.first("number", "id")), title=title,
        company=F.split("board", "/")[0], url=i.text("html_url"), work_model=tx.work_model(_spaced(title, place)), city=place,
        published_date=dt.iso_date(i.text("created_at")), skills=ar.first_n(labels, 20), description=tx.strip_html(i.text("body")),
        categories=F.array(F.lit("Vagas no GitHub")),
        contract_types=F.filter(labels, lambda v: F.upper(v).isin("CLT", "PJ", "COOPERADO")),
    )


# ---------------------------------------------------------------- company portals


def _providerit(i: Item) -> dict[str, Column]:
    tags = F.when(is_object(i.raw("tags")), F.map_values(F.coalesce(F.try_variant_get(i.raw("tags"), "$", "map<string,string>"), F.from_json(F.lit("{}"), "map<string,string>"))))
    tags = F.coalesce(tags, F.transform(i.elements("tags"), as_text))
    tail = F.regexp_extract(F.regexp_replace("url", "/+$", ""), r"([^/]*)$", 1)
    return _br(
        native_id=F.replace(F.coalesce(F.nullif(i.text("pk"), F.lit("")), tail), F.lit("JOB:"), F.lit("")), title=i.text("title"),
        company=F.lit("Provider IT"), url=F.col("url"), work_model=tx.work_model(i.first("workingModel.label", "workingModel.label-pt-BR")),
        city=tx.first_non_blank(i.text("location.city.label"), F.lit("Brasil")), state=i.first("location.city.uf", "location.provinceOrState.value"),
        published_date=dt.iso_date(i.text("openingDate")), expires_date=dt.iso_date(i.text("hiringEndDate")),
        description=tx.strip_html(_spaced(i.text("description"), i.text("responsibilities"), i.text("requirements"))),
        categories=ar.singleton(i.text("category.label")), levels=ar.singleton(i.text("experienceLevel.label")),
        skills=F.filter(tags, lambda v: tx.text_or_blank(v) != ""), contract_types=ar.singleton(i.text("employmentType.label")),
    )


def _fiserv_places(i: Item) -> Column:
    listed = F.concat(
        F.array(i.text("location"), i.text("cityStateCountry")), F.transform(i.elements("multi_location"), as_text),
        F.transform(i.objects("multi_location_array"), lambda e: as_text(field(e, "location"))),
    )
    return F.array_join(F.filter(listed, lambda v: v != ""), " | ")


def _fiserv(i: Item) -> dict[str, Column]:
    remote = tx.matches(_fiserv_places(i), r"(?iu)\bremote\b")
    native, title = i.first("jobId", "reqId", "jobSeqNo"), i.text("title")
    built = F.concat(F.lit("https://careers.fiserv.com/us/en/job/"), native, F.lit("/"), tx.plain_slug(title))
    several = F.transform(i.elements("multi_category"), as_text)
    return _br(
        native_id=native, title=title, company=F.lit("Fiserv"),
        url=F.when(i.truthy("jobUrl"), tx.absolute_url("https://careers.fiserv.com", i.text("jobUrl"))).otherwise(built),
        work_model=F.when(remote, "remote").otherwise("on-site"),
        city=F.when(remote, "Brasil").otherwise(tx.first_non_blank(i.text("city"), F.lit("São Paulo"))),
        state=F.when(remote, "").otherwise(tx.first_non_blank(i.text("state"), F.lit("SP"))),
        published_date=dt.iso_date(i.text("postedDate")), description=tx.strip_html(i.text("descriptionTeaser")),
        categories=F.when(F.size(several) > 0, several).otherwise(ar.singleton(i.text("category"))), contract_types=ar.singleton(i.text("type")),
    )


def _fiserv_keep(i: Item) -> Column:
    here = (i.text("country") == "Brazil") | tx.matches(_fiserv_places(i), r"(?iu)\b(?:Brazil|S[aã]o Paulo)\b")
    return here & (i.first("jobId", "reqId", "jobSeqNo") != "")


def _brazil_offices(i: Item) -> Column:
    return F.filter(i.elements("locations"), lambda e: as_text(field(e, "country")) == "Brazil")


def _revolut(i: Item) -> dict[str, Column]:
    home = _brazil_offices(i)
    remote = F.exists(home, lambda e: as_text(field(e, "type")) == "remote")
    offices = F.filter(home, lambda e: as_text(field(e, "type")) == "office")
    office = F.coalesce(as_text(field(F.get(offices, F.lit(0)), "name")), F.lit(""))
    return _br(
        native_id=i.text("id"), title=i.text("text"), company=F.lit("Revolut"),
        url=F.concat(F.lit("https://www.revolut.com/careers/position/"), tx.plain_slug(i.text("text")), F.lit("-"), i.text("id"), F.lit("/")),
        work_model=F.when(remote, "remote").otherwise("on-site"),
        city=F.when(remote, "Brasil").otherwise(tx.first_non_blank(office, F.lit("São Paulo"))), state=F.when(remote, "").otherwise("SP"),
        description=tx.strip_html(i.text("description")), categories=ar.singleton(i.text("team")),
    )


def _inlog(i: Item) -> dict[str, Column]:
    model = tx.work_model(i.first("modelo_trabalho", "localizacao"))
    remote = model == "remote"
    return _br(
        native_id=i.text("id"), title=i.text("Titulo_vaga"), company=tx.first_non_blank(i.text("empresa_nome"), F.lit("Inlog")),
        url=F.concat(F.lit("https://rs.tagguirh.com.br/visualizar-vaga/grupoinlog/"), i.text("id")),
        work_model=F.when(model == "", "on-site").otherwise(model),
        city=F.when(remote, "Brasil").otherwise(tx.first_non_blank(i.text("localizacao"), F.lit("Brasil"))),
        published_date=dt.iso_date(i.text("created_at")), categories=ar.singleton(i.text("Departamento")),
        contract_types=ar.singleton(i.text("tipo_contrato")),
    )


def _career_board(company: str):
    def mapping(i: Item) -> dict[str, Column]:
        title, raw_place = i.text("title"), i.text("location.name")
        description = tx.strip_html(tx.unescape(i.text("content")))
        stated = F.regexp_extract(description, r"(?iu)((?:modelo|modalidade|formato)\s+(?:de\s+)?trabalho.{0,100})", 1)
        return _br(
            native_id=i.first("id", "internal_job_id", "absolute_url"), title=title, company=F.lit(company), url=i.text("absolute_url"),
            work_model=tx.first_non_blank(tx.work_model(_spaced(title, raw_place)), tx.work_model(stated)),
            city=tx.board_location(raw_place, title), published_date=dt.iso_date(i.first("first_published", "updated_at")),
            expires_date=dt.iso_date(i.text("application_deadline")),
            skills=ar.first_n(metadata_values(i.raw("metadata"), fx.METADATA_KEYWORD_NAMES), 12), description=description,
            categories=i.names("departments", "name", distinct=False),
            contract_types=metadata_values(i.raw("metadata"), fx.METADATA_CONTRACT_NAMES),
            pcd=tx.matches(_spaced(title, F.substring(description, 1, 700)), fx.PCD_TEXT),
        )

    return mapping


def _suite_places(i: Item) -> Column:
    """Primary and further locations; child lists come bare or wrapped in ``items``."""

    def children(name: str) -> Column:
        value = i.raw(name)
        listed = F.when(is_object(value), elements(field(value, "items"))).otherwise(elements(value))
        return F.transform(F.filter(listed, is_object), lambda e: tx.tidy_location(
            F.coalesce(*[F.nullif(as_text(field(e, k)), F.lit("")) for k in ("LocationName", "PrimaryLocation", "Name")], F.lit(""))))

    every = F.concat(F.array(tx.tidy_location(i.text("PrimaryLocation"))), children("secondaryLocations"), children("otherWorkLocations"))
    return F.array_distinct(F.filter(every, lambda v: v != ""))


def _suite(source: str):
    host, slug, locale, company = fx.SUITE_SITES[source]

    def mapping(i: Item) -> dict[str, Column]:
        title = tx.strip(i.text("Title"))
        description = tx.strip_html(_spaced(i.text("ShortDescriptionStr"), i.text("ExternalResponsibilitiesStr"), i.text("ExternalQualificationsStr")))
        several = lambda *names: ar.trimmed_distinct(F.array(*[i.text(n) for n in names]))
        country = F.upper(i.text("PrimaryLocationCountry"))
        return {
            "native_id": i.text("Id"), "title": title, "company": F.lit(company),
            "url": F.concat(F.lit(f"{host}/hcmUI/CandidateExperience/{locale}/sites/{slug}/job/"), i.text("Id")),
            "work_model": tx.work_model(_spaced(title, i.text("WorkplaceType"), i.text("PrimaryLocation"))),
            "city": F.array_join(_suite_places(i), " · "), "country": country, "market": F.when(country == "BR", "BR").otherwise(""),
            "published_date": dt.iso_date(i.text("PostedDate")), "expires_date": dt.iso_date(i.text("PostingEndDate")),
            "description": description, "categories": several("JobFunction", "JobFamily", "Department", "Organization"),
            "contract_types": several("ContractType", "JobType", "JobSchedule"),
            "pcd": tx.matches(_spaced(title, F.substring(description, 1, 700)), fx.PCD_TEXT_AFFIRMATIVE),
        }

    def keep(i: Item) -> Column:
        known = i.truthy("Id")
        return known & (F.upper(i.text("PrimaryLocationCountry")) == "BR") if source == "autozone" else known

    return Spec("items.0.requisitionList", mapping, keep, "last")


# ---------------------------------------------------------------- world-wide boards


def _themuse(i: Item) -> dict[str, Column]:
    places = F.transform(i.elements("locations"), lambda e: as_text(field(e, "name")))
    remote = F.exists(places, lambda v: F.lower(v).contains("remote") | F.lower(v).contains("flexible"))
    first = F.coalesce(F.get(places, F.lit(0)), F.lit(""))
    return {
        "native_id": i.text("id"), "title": i.text("name"), "company": i.text("company.name"), "url": i.text("refs.landing_page"),
        "work_model": tx.work_model(F.array_join(places, ", "), remote), "city": first,
        "country": F.when(remote, "Remote").otherwise(first), "market": F.when(remote, "Global remote").otherwise("Global"),
        "published_date": dt.iso_date(i.text("publication_date")), "description": tx.strip_html(i.text("contents")),
        "levels": F.filter(F.transform(i.elements("levels"), lambda e: as_text(field(e, "name"))), lambda v: v != ""),
        "categories": F.filter(F.transform(i.elements("categories"), lambda e: as_text(field(e, "name"))), lambda v: v != ""),
    }


def _tags(i: Item, path: str) -> Column:
    return ar.first_n(F.filter(F.transform(i.elements(path), as_text), lambda v: v != ""), 8)


def _remote(**columns: Column) -> dict[str, Column]:
    return {"work_model": F.lit("remote"), "market": F.lit("Global remote"), **columns}


def _remotive(i: Item) -> dict[str, Column]:
    return _remote(
        native_id=i.first("id", "url"), title=i.text("title"), company=i.text("company_name"), url=i.text("url"),
        country=i.text("candidate_required_location"), published_date=dt.iso_date(i.text("publication_date")), skills=_tags(i, "tags"),
        description=tx.strip_html(i.text("description")), categories=ar.singleton(i.text("category")),
    )


def _jobicy(i: Item) -> dict[str, Column]:
    industry = F.when(
        F.schema_of_variant(i.raw("jobIndustry")).startswith("ARRAY"), F.transform(i.elements("jobIndustry"), as_text)
    ).otherwise(F.array(i.text("jobIndustry")))
    return _remote(
        native_id=i.first("id", "url"), title=i.text("jobTitle"), company=i.text("companyName"), url=i.text("url"), country=i.text("jobGeo"),
        published_date=dt.iso_date(i.text("pubDate")), description=tx.strip_html(i.text("jobExcerpt")),
        categories=F.filter(F.coalesce(industry, F.array().cast("array<string>")), lambda v: v != ""),
    )


def _remoteok(i: Item) -> dict[str, Column]:
    low, high = F.nullif(i.number("salary_min"), F.lit(0.0)), F.nullif(i.number("salary_max"), F.lit(0.0))
    return _remote(
        native_id=i.text("id"), title=i.text("position"), company=i.text("company"),
        url=tx.first_non_blank(i.text("url"), F.concat(F.lit("https://remoteok.com/remote-jobs/"), i.text("id"))),
        salary_min=low, salary_max=high, salary_currency=F.when(low.isNotNull() | high.isNotNull(), "USD"),
        published_date=dt.iso_date(i.text("date")), skills=_tags(i, "tags"), description=tx.strip_html(i.text("description")),
    )


def _himalayas(i: Item) -> dict[str, Column]:
    limits = i.raw("locationRestrictions")
    listed = F.array_join(F.transform(elements(limits), as_text), ", ")
    country = F.when(F.coalesce(F.schema_of_variant(limits).startswith("ARRAY"), F.lit(True)), listed).otherwise(i.text("locationRestrictions"))
    return _remote(
        native_id=i.first("guid", "title"), title=i.text("title"), company=i.text("companyName"), url=i.first("applicationLink", "guid"),
        country=country, published_date=dt.iso_date(i.text("pubDate")), skills=_tags(i, "categories"), description=tx.strip_html(i.text("excerpt")),
    )


def _workingnomads(i: Item) -> dict[str, Column]:
    return {
        "native_id": i.text("url"), "title": i.text("title"), "company": i.text("company_name"), "url": i.text("url"),
        "work_model": tx.work_model(i.text("location")), "country": i.text("location"), "market": F.lit("Global remote"),
        "published_date": dt.iso_date(i.text("pub_date")), "description": tx.strip_html(i.text("description")),
        "categories": ar.singleton(i.text("category_name")),
    }


def _arbeitnow(i: Item) -> dict[str, Column]:
    return {
        "native_id": i.first("slug", "url"), "title": i.text("title"), "company": i.text("company_name"), "url": i.text("url"),
        "work_model": tx.work_model(i.text("location"), i.truthy("remote")), "country": i.text("location"), "market": F.lit("Global remote"),
        "published_date": dt.iso_date(i.text("created_at")), "skills": _tags(i, "tags"), "description": tx.strip_html(i.text("description")),
    }


def _greenhouse(i: Item) -> dict[str, Column]:
    place, title = tx.strip(i.text("location.name")), i.text("title")

    def contract(e: Column) -> Column:
        name = F.lower(F.regexp_replace(tx.strip(as_text(field(e, "name"))), ":+$", ""))
        value = field(e, "value")
        listed = F.when(F.schema_of_variant(value).startswith("ARRAY"), F.transform(elements(value), as_text)).otherwise(F.array(as_text(value)))
        return F.when(name.isin(*fx.METADATA_CONTRACT_NAMES), F.coalesce(listed, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))

    return _br(
        native_id=i.first("id", "internal_job_id"), title=title,
        company=F.coalesce(F.nullif(i.text("company_name"), F.lit("")), F.nullif(F.col("board_company"), F.lit("")), F.col("board")),
        url=i.text("absolute_url"), work_model=tx.work_model(_spaced(title, place)), city=place,
        published_date=dt.iso_date(i.first("first_published", "updated_at")), expires_date=dt.iso_date(i.text("application_deadline")),
        categories=F.filter(F.transform(i.elements("departments"), lambda e: as_text(field(e, "name"))), lambda v: v != ""),
        contract_types=ar.trimmed(F.flatten(F.transform(i.elements("metadata"), contract))), pcd=tx.matches(title, fx.PCD_TEXT),
    )


def _greenhouse_keep(i: Item) -> Column:
    return F.coalesce(F.col("brazil_only"), F.lit(False)) | names_brazil(i.text("location.name"))


def _board_title() -> Column:
    return F.coalesce(tx.lookup(fx.BOARD_TITLES, F.col("board")), F.initcap("board"))


def _lever(i: Item) -> dict[str, Column]:
    place = i.text("categories.location")
    reach = market_of_place(place)
    return {
        "native_id": i.text("id"), "title": i.text("text"), "company": _board_title(), "url": i.text("hostedUrl"),
        "work_model": tx.work_model(_spaced(i.text("categories.commitment"), place)), "city": place, "country": reach["country"],
        "market": reach["market"], "published_date": dt.iso_date(i.text("createdAt")),
        "categories": F.array(i.first("categories.department", "categories.team")),
    }


def _ashby(i: Item) -> dict[str, Column]:
    place = i.first("location", "locationName")
    reach, remote = market_of_place(place), i.truthy("isRemote")
    return {
        "native_id": i.first("id", "jobId"), "title": i.text("title"), "company": _board_title(), "url": i.first("jobUrl", "applyUrl"),
        "work_model": tx.work_model(place, remote), "city": place, "country": reach["country"],
        "market": F.when(remote, "Global remote").otherwise(reach["market"]), "published_date": dt.iso_date(i.text("publishedAt")),
        "categories": F.array(i.first("department", "teamName")),
    }


SPECS: dict[str, Spec] = {
    "inhire": Spec("", _inhire),
    "empregare": Spec("model.dados", _empregare, lambda i: i.text("id") != "", "last"),
    "abler": Spec("data", _abler, _abler_keep, "first"),
    "accenture": Spec("data", _accenture, _accenture_keep, "last"),
    "bradesco": Spec("data.requisitions", _bradesco, _bradesco_keep, "first"),
    "gupy": Spec("data", _gupy, None, "last"),
    "solides": Spec("data.data", _solides, lambda i: i.text("id") != "", "last"),
    "geekhunter": Spec("data", _geekhunter, None, "last"),
    "github": Spec("", _github, lambda i: ~i.truthy("pull_request")),
    "providerit": Spec("props.pageProps.jobViewData", _providerit, lambda i: ~i.is_false("isAvailableOnCareersSite")),
    "fiserv": Spec("eagerLoadRefineSearch.data.jobs", _fiserv, _fiserv_keep, "first"),
    "revolut": Spec("props.pageProps.positions", _revolut, lambda i: F.size(_brazil_offices(i)) > 0),
    "inlog": Spec("", _inlog),
    "stone": Spec("jobs", _career_board("Stone")),
    "ifood": Spec("jobs", _career_board("iFood")),
    **{name: _suite(name) for name in fx.SUITE_SITES},
    "themuse": Spec("results", _themuse),
    "remotive": Spec("jobs", _remotive, None, "first"),
    "jobicy": Spec("jobs", _jobicy, None, "first"),
    "remoteok": Spec("", _remoteok, lambda i: i.truthy("id")),
    "himalayas": Spec("jobs", _himalayas),
    "workingnomads": Spec("", _workingnomads),
    "arbeitnow": Spec("data", _arbeitnow),
    "greenhouse": Spec("jobs", _greenhouse, _greenhouse_keep),
    "lever": Spec("", _lever, None, "all", 120),
    "ashby": Spec("jobs", _ashby, None, "all", 120),
}


def _list_path(path: str) -> str:
    keys = [k for k in path.split(".") if k]
    return "$" + "".join(f"[{k}]" if k.isdigit() else f"['{k}']" for k in keys)


def exploded(landed: DataFrame, path: str, keep_included: bool = False) -> DataFrame:
    """One row per payload item with its place; a single object counts as a list of one."""
    parsed = landed.withColumn("_payload", F.try_parse_json("body"))
    node = F.try_variant_get("_payload", _list_path(path), "variant")
    # a payload wrapped in ``items`` is unwrapped (newer framework version)
    node = F.when(is_object(node) & field(node, "items").isNotNull(), field(node, "items")).otherwise(node)
    listed = F.when(is_object(node), F.array(node)).otherwise(elements(node))
    if keep_included:
        parsed = parsed.withColumn("included", field(F.col("_payload"), "included"))
    return parsed.select("*", F.posexplode(listed).alias("_pos", "_item")).drop("_payload", "body")


def rows(landed: DataFrame, source: str, spec: Spec | None = None) -> DataFrame:
    """Canonical rows of one source, with ``page`` and ``item_ord``.

    Optional landed columns: ``board_company`` and ``brazil_only`` (joined board configuration), ``page_company``.
    """
    spec = spec or SPECS[source]
    own = landed.filter(F.col("source") == source)
    for name, kind in (("board", "string"), ("board_company", "string"), ("page_company", "string"), ("brazil_only", "boolean")):
        if name not in own.columns:
            own = own.withColumn(name, F.lit(None).cast(kind))
    items = exploded(own, spec.items, keep_included=source == "abler")
    if spec.first_items:
        items = items.filter(F.col("_pos") < spec.first_items)
    item = Item(F.col("_item"))
    if spec.keep:
        items = items.filter(F.coalesce(spec.keep(item), F.lit(False)))
    mapped = items.select(
        *canonical({**spec.map(item), "source": F.lit(source)}), F.col("page"), F.col("_pos").alias("item_ord")
    )
    if spec.repeats == "all":
        return mapped
    key = F.coalesce(F.nullif(F.col("native_id"), F.lit("")), F.col("url"))
    return (keep_last if spec.repeats == "last" else keep_first)(mapped, [key], ["page", "item_ord"])


GUPY_CAREER_PAGE = Spec("props.pageProps.jobs", _gupy_page, lambda i: i.truthy("id"))

__all__ = ["GUPY_CAREER_PAGE", "JOB", "LANDED", "SPECS", "Spec", "exploded", "rows"]
