"""Pages (``source, board, page, url, body``) to canonical rows and links, by patterns over the markup."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import arrays as ar, dates as dt, numbers as nu, text as tx
from jobloom.operators.dedupe import keep_first, keep_last
from jobloom.schema import canonical

ANCHOR = r"""(?is)<a\b[^>]*?\bhref=["']([^"']*)["'][^>]*>(.*?)</a>"""


def text_nodes(markup: Column) -> Column:
    """Trimmed text between tags, blanks dropped."""
    return ar.trimmed(F.transform(F.split(tx.text_or_blank(markup), "<[^>]*>"), tx.unescape))


def inner(markup: Column, pattern: str, group: int = 1) -> Column:
    """Plain text of the first match of a pattern's group."""
    return tx.strip_html(tx.unescape(F.regexp_extract(markup, pattern, group)))


def attribute(tag: Column, name: str) -> Column:
    return tx.unescape(F.regexp_extract(tag, rf"""(?is)\b{name}=["']([^"']*)["']""", 1))


def blocks(pages: DataFrame, pattern: str, before: bool = False) -> DataFrame:
    """One row per card: every match of ``pattern``, or the text from each match to the next (``before``)."""
    if before:
        parts = F.split("body", rf"(?=(?:{pattern}))")
        return pages.select("*", F.posexplode(parts).alias("_pos", "_card")).filter(F.col("_card").rlike(pattern)).drop("body")
    return pages.select("*", F.posexplode(F.regexp_extract_all("body", F.lit(pattern), 0)).alias("_pos", "_card")).drop("body")


def element_blocks(pages: DataFrame, tag: str, opening: str) -> DataFrame:
    """One row per outermost ``tag`` element whose start tag matches ``opening``, from its start to its own end tag.

    Start and end tags are counted as a parser counts them: elements of the same name inside belong to the card, a start tag that
    closes itself does not count, comments, scripts and styles hold no tags, and a card that never ends is not given.
    """
    quiet = F.regexp_replace(F.regexp_replace("body", r"(?s)<!--.*?-->", ""), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
    pieces = F.split(quiet, rf"(?i)(?=<{tag}\b|</{tag}\s*>)")
    none = F.array().cast("array<string>")
    start = F.struct(F.lit(0).alias("depth"), none.alias("card"), none.alias("cards"))

    def step(state: Column, piece: Column) -> Column:
        whole = piece.rlike(rf"(?is)^<{tag}\b[^>]*/>")
        opens, closes = piece.rlike(rf"(?i)^<{tag}\b") & ~whole, piece.rlike(rf"(?i)^</{tag}\s*>")
        depth = state["depth"]
        begins, ends = (depth == 0) & opens & F.regexp_extract(piece, r"(?s)^<[^>]*>", 0).rlike(opening), (depth == 1) & closes
        after = F.when(begins, 1).when(depth == 0, 0).when(opens, depth + 1).when(closes, depth - 1).otherwise(depth)
        card = F.when(begins, F.array(piece)).when(after > 0, F.concat(state["card"], F.array(piece))).otherwise(none)
        cards = F.when(ends, F.concat(state["cards"], F.array(F.array_join(state["card"], "")))).otherwise(state["cards"])
        return F.struct(after.alias("depth"), card.alias("card"), cards.alias("cards"))

    found = F.aggregate(pieces, start, step, lambda state: state["cards"])
    return pages.select("*", F.posexplode(found).alias("_pos", "_card")).drop("body")


def _path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#][\s\S]*$", "")


def links(pages: DataFrame, pattern: str = ANCHOR, base: Column | None = None) -> DataFrame:
    """``page, item_ord, href, url, label`` of anchors with a label; first occurrence of each link per page kept."""
    cards = blocks(pages, pattern)
    href = tx.strip(tx.unescape(F.regexp_extract("_card", pattern, 1)))
    label = inner(F.col("_card"), pattern, 2)
    root = base if base is not None else F.regexp_extract("url", r"^([a-z]+://[^/?#]+)", 1)
    absolute = F.when(href.rlike("^[a-z]+:"), href).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(root, F.lit("/"), href))
    found = cards.select("page", F.col("_pos").alias("item_ord"), href.alias("href"), absolute.alias("url"), label.alias("label"))
    return keep_first(found.filter((F.col("href") != "") & (F.col("label") != "")), ["page", "url"], ["item_ord"])


def sitemap_links(pages: DataFrame, prefix: str) -> DataFrame:
    """Distinct links of a sitemap that start with a prefix, sorted."""
    found = F.regexp_extract_all("body", F.lit(rf"<loc>({tx.regex_quote(prefix)}[^<]+)</loc>"), 1)
    return pages.select(F.explode(F.transform(found, tx.unescape)).alias("url")).distinct().orderBy("url")


# ---------------------------------------------------------------- card specs


@dataclass(frozen=True)
class CardSpec:
    """``fields`` cuts a card into named pieces, each computed once; ``map`` builds canonical columns from them.

    A card is a match of ``pattern``, the text up to the next match (``before``), or the whole ``element`` whose start tag matches.
    """

    pattern: str
    fields: Callable[[Column], dict[str, Column]]
    map: Callable[[Callable[[str], Column]], dict[str, Column]]
    repeats: str = "first"
    before: bool = False
    element: str = ""


def _piece(name: str) -> Column:
    return F.col(f"_f_{name}")


def _br(**more: Column) -> dict[str, Column]:
    return {"country": F.lit("BR"), "market": F.lit("BR"), **more}


def _path_jobs(base: str, skip: str, company: str, **fixed: str):
    def fields(card: Column) -> dict[str, Column]:
        href = tx.unescape(F.regexp_extract(card, ANCHOR, 1))
        return {"href": href, "path": _path(href), "title": F.array_join(text_nodes(F.regexp_extract(card, ANCHOR, 2)), " ")}

    def mapping(f) -> dict[str, Column]:
        href, path, title = f("href"), f("path"), f("title")
        usable = path.startswith("/job/") & (F.lower(title) != skip)
        more = {k: F.lit(v) for k, v in fixed.items() if k != "contract"}
        if "contract" in fixed:
            more["contract_types"] = F.array(F.lit(fixed["contract"]))
        return _br(
            native_id=F.regexp_extract(path, r"(?s)^(?:.*-jid-)?(.*)$", 1), title=F.when(usable, title), company=F.lit(company),
            url=tx.absolute_url(base, href), **more,
        )

    return CardSpec(ANCHOR, fields, mapping)


def _vacancy_cards(source: str, host: str):
    """Cards whose text parts are title, contract and place in no fixed order."""
    anchor = r"""(?is)<a\b[^>]*?\bhref=["']([^"']*/([^/"']+)/vacancy/(\d+)-[^"']*)["'][^>]*>(.*?)</a>"""

    def fields(card: Column) -> dict[str, Column]:
        return {
            "parts": text_nodes(F.regexp_extract(card, anchor, 4)), "number": F.regexp_extract(card, anchor, 3),
            "href": tx.unescape(F.regexp_extract(card, anchor, 1)),
        }

    def mapping(f) -> dict[str, Column]:
        parts, number = f("parts"), f("number")
        rest = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
        contract = F.coalesce(F.get(F.filter(rest, lambda v: v.rlike(fx.CARD_CONTRACT_LINE)), F.lit(0)), F.lit(""))
        others = F.filter(rest, lambda v: v != contract)
        place = F.coalesce(F.get(F.reverse(others), F.lit(0)), F.lit(""))
        own = source == "digisystem"
        company = F.lit("Digisystem") if own else F.coalesce(tx.lookup(fx.CARD_PAGE_COMPANIES, F.col("board")), F.col("board"))
        return _br(
            native_id=number if own else F.concat(F.col("board"), F.lit(":"), number), title=F.get(parts, F.lit(0)), company=company,
            url=tx.absolute_url(host, f("href")), work_model=tx.work_model(place), city=place,
            contract_types=tx.split_alternatives(contract),
        )

    return CardSpec(anchor, fields, mapping, "last")


_CATALOG_CARD = r"""(?is)\bclass=["'][^"']*index__job-opportunities__grid__item"""
_CATALOG_LINK = r"""(?is)(<a\b[^>]*data-cy=["']job-opportunity-link["'][^>]*>)(.*?)</a>"""


def _catalog_fields(card: Column) -> dict[str, Column]:
    head = F.regexp_extract(card, r"(?is)^(<div\b[^>]*>)", 1)
    tag = F.regexp_extract(card, _CATALOG_LINK, 1)
    title = tx.strip(tx.first_non_blank(
        attribute(head, "data-title"), attribute(tag, "data-title"), F.array_join(text_nodes(F.regexp_extract(card, _CATALOG_LINK, 2)), " ")))
    return {
        "link": tx.absolute_url("https://atracaodetalentos.totvs.app", attribute(tag, "href")), "title": title,
        "remote": F.lower(attribute(head, "data-hide-location")) == "true", "city": tx.strip(attribute(head, "data-city-name")),
        "state": F.upper(tx.strip(attribute(head, "data-state-small-name"))),
    }


def _catalog(f) -> dict[str, Column]:
    link, title, remote = f("link"), f("title"), f("remote")
    number = F.regexp_extract(link, r"(?i)^https://atracaodetalentos\.totvs\.app/([^/]+)/(\d+)/[^/?#]+/?$", 2)
    board = F.regexp_extract(link, r"(?i)^https://atracaodetalentos\.totvs\.app/([^/]+)/", 1)
    usable = (number != "") & (F.lower(board) == F.lower(F.col("board")))
    return _br(
        native_id=F.concat(F.col("board"), F.lit(":"), number), title=F.when(usable, title),
        company=F.coalesce(tx.lookup(fx.CATALOG_COMPANIES, F.col("board")), F.col("board")), url=link,
        work_model=tx.work_model(title, remote), city=F.when(remote, "").otherwise(f("city")),
        state=F.when(remote, "").otherwise(f("state")),
        pcd=F.lower(title).contains("pcd") | F.lower(title).contains("pessoa com defici"),
    )


def catalog_details(pages: DataFrame) -> DataFrame:
    """``url, work_model, city, state, contract_types`` of landed detail pages."""

    def tagged(marker: str) -> Column:
        return tx.strip_html(F.regexp_extract("body", rf"(?is)<(?:p|div)\b(?=[^>]*{marker})[^>]*>(.*?)</(?:p|div)>", 1))

    subtitle = tagged(r"""class=["'][^"']*job-opportunity__subtitle[^"']*["']""")
    regime = tagged(r"""data-cy=["']mobile-regime["']""")
    place = r"^(.+?)\s*-\s*([A-Z]{2})$"
    part = F.coalesce(F.get(F.filter(F.transform(F.split(subtitle, r"\|"), tx.strip), lambda p: p.rlike(place)), F.lit(0)), F.lit(""))
    return pages.select(
        "url", tx.work_model(subtitle).alias("work_model"), tx.strip(F.regexp_extract(part, place, 1)).alias("city"),
        F.regexp_extract(part, place, 2).alias("state"), tx.labels_in_text(regime, fx.REGIME_CONTRACTS).alias("contract_types"),
    )


_BULLET = "•"


def _badge_fields(card: Column) -> dict[str, Column]:
    def element(tag: str, cls: str) -> Column:
        raw = F.regexp_extract(card, rf"""(?is)<{tag}[^>]*class=["'][^"']*{cls}[^"']*["'][^>]*>(.*?)</{tag}>""", 1)
        return _clean(raw)

    def _clean(raw: Column) -> Column:
        return tx.squeeze(tx.strip_html(tx.unescape(F.regexp_replace(raw, r"(?is)<span[^>]*vaga-nova-badge[^>]*>.*?</span>", " "))))

    hashtags = F.regexp_extract_all(card, F.lit(r"""(?is)<a[^>]*class=["'][^"']*hashtag[^"']*["'][^>]*>(.*?)</a>"""), 1)
    return {
        "href": tx.unescape(F.regexp_extract(card, r"""(?i)data-href=["']([^"']+)["']""", 1)), "title": element("h3", "vaga-titulo"),
        "company": element("span", "vaga-empresa-nome"), "place": element("div", "vaga-local-linha"),
        "summary": element("p", "vaga-resumo-linha"), "meta": element("p", "vaga-meta-extra"), "tags": F.transform(hashtags, _clean),
        "pay": nu.reais(card), "time": F.regexp_extract(card, r"""(?i)<time[^>]+datetime=["'](\d{4}-\d{2}-\d{2}(?:T[0-9:+-]+)?)""", 1),
    }


def _badge_card(f) -> dict[str, Column]:
    href, title, company, place, summary, meta, tags, pay = (
        f(n) for n in ("href", "title", "company", "place", "summary", "meta", "tags", "pay")
    )
    split = lambda c: ar.trimmed(F.split(c, _BULLET))
    parts, place_parts = split(summary), split(place)
    tail = F.get(place_parts, F.size(place_parts) - 1)
    return _br(
        native_id=tx.first_non_blank(F.regexp_extract(href, r"-(\d+)\.php$", 1), href),
        title=F.when((href != "") & (company != ""), title), company=company,
        url=F.concat(F.lit("https://www.nerdin.com.br/"), F.regexp_replace(href, "^/+", "")), work_model=tx.work_model(summary), city=place,
        state=F.when(place.contains(_BULLET) & (F.length(tail) == 2), F.upper(tail)).otherwise(""),
        salary_min=pay["low"], salary_max=pay["high"], salary_currency=pay["currency"],
        published_date=f("time"),
        skills=F.transform(F.filter(tags, lambda t: t != ""), lambda t: F.regexp_replace(t, "^#+", "")), levels=parts,
        categories=F.concat(ar.first_n(ar.trimmed(ar.first_n(F.split(meta, _BULLET), 1)), 1), tags),
        contract_types=F.filter(parts, lambda p: F.lower(p).isin("clt", "pj", "freelancer", "cooperado")),
        pcd=F.lower(F.concat_ws(" ", title, summary)).contains("pcd"),
    )


_DETAIL_CARD = r'(?is)<a[^>]+class="card card-vacancy[^"]*"[^>]+href="(/Detail/(\d+))"[^>]*>(.*?)</a>'


def _icon_fields(card: Column) -> dict[str, Column]:
    block = F.regexp_extract(card, _DETAIL_CARD, 3)
    value = lambda icon: tx.strip_html(tx.unescape(F.regexp_extract(block, rf"(?is){icon}.*?</div>\s*([^<]+)", 1)))
    return {
        "place": value("icon-location-pin-1"), "contract": value("icon-sheet"), "model": value("icon-buildings"),
        "title": tx.unescape(F.regexp_extract(block, r'(?i)<h3[^>]+title="([^"]+)"', 1)), "id": F.regexp_extract(card, _DETAIL_CARD, 2),
        "path": F.regexp_extract(card, _DETAIL_CARD, 1), "date": F.regexp_extract(block, r"(?i)vacancy-date[^>]*>([^<]+)", 1),
    }


def _icon_card(f) -> dict[str, Column]:
    place = F.split(f("place"), r"\s+-\s+", 2)
    contract = f("contract")
    return _br(
        native_id=f("id"), title=f("title"), company=F.lit("Metalfrio Solutions"),
        url=F.concat(F.lit("https://metalfriosolutions.pandape.infojobs.com.br"), f("path")),
        work_model=tx.first_non_blank(tx.work_model(f("model")), F.lit("on-site")), city=tx.strip(place[0]),
        state=tx.strip(F.coalesce(F.get(place, F.lit(1)), F.lit(""))),
        published_date=dt.short_date(f("date"), F.col("today")),
        contract_types=ar.singleton(contract), categories=F.array(F.lit("Metalfrio")),
    )


_TABLE_LINK = r'(?is)<a href="([^"]+)" class="jobTitle-link">(.*?)</a>'


def _table_fields(card: Column) -> dict[str, Column]:
    href = tx.unescape(F.regexp_extract(card, _TABLE_LINK, 1))
    cell = lambda name: F.regexp_extract(card, rf'(?is)<td class="{name}[^>]*>(.*?)</td>', 1)
    text = lambda raw: tx.strip_html(tx.unescape(raw))
    return {
        "href": href, "title": text(F.regexp_extract(card, _TABLE_LINK, 2)), "number": F.regexp_extract(href, r"/(\d+)/?$", 1),
        "place": F.when(card.contains('<td class="colLocation'), text(cell("colLocation"))).otherwise("Brasil"),
        "date": tx.strip_html(cell("colDate")), "category": text(cell("colFacility")),
    }


def _table_row(f) -> dict[str, Column]:
    href, title, number, place = f("href"), f("title"), f("number"), f("place")
    low = F.lower(title)
    return _br(
        native_id=number, title=F.when(number != "", title),
        company=F.when(low.contains("nespresso"), "Nespresso").when(low.contains("purina"), "Purina").otherwise("Nestlé"),
        url=tx.absolute_url("https://jobdetails.nestle.com", href), work_model=tx.first_non_blank(tx.work_model(title), F.lit("on-site")),
        city=tx.first_non_blank(tx.strip(F.split(place, ",")[0]), F.lit("Brasil")), published_date=dt.english_date(f("date")),
        categories=ar.singleton(f("category")),
    )


_LISTED_LINK = r"""(?i)<a[^>]+href=["']([^"']*(?:/jobs/|/vagas/)[^"']*)["'][^>]*>([\s\S]*?)</a>"""


def _listed(company: str, category: str, base: str):
    def fields(card: Column) -> dict[str, Column]:
        return {
            "link": tx.absolute_url(base, tx.strip(tx.unescape(F.regexp_extract(card, _LISTED_LINK, 1)))), "title": inner(card, _LISTED_LINK, 2),
        }

    def mapping(f) -> dict[str, Column]:
        link, title = f("link"), f("title")
        return _br(
            native_id=tx.last_path_segment(link), title=title, company=F.lit(company), url=link, work_model=tx.work_model(title),
            city=F.lit("Brasil"), categories=F.array(F.lit(category)),
        )

    return CardSpec(_LISTED_LINK, fields, mapping)


_CMS_CARD = r'(?i)<div[^>]+class="jobs-list-cms-position"[^>]*>([\s\S]*?)<a[^>]+href="([^"]*/jobs-positions/[^"]+)"'


def _cms_fields(card: Column) -> dict[str, Column]:
    block, path = F.regexp_extract(card, _CMS_CARD, 1), F.regexp_extract(card, _CMS_CARD, 2)
    fields = F.transform(
        F.regexp_extract_all(block, F.lit(r'(?i)fs-list-field="(?:location-type|work-type|location)"[^>]*>([\s\S]*?)</div>'), 1),
        lambda v: tx.strip_html(tx.unescape(v)),
    )
    return {"path": path, "fields": fields, "title": inner(block, r'(?i)is-open-position">([\s\S]*?)</div>')}


def _cms_card(f) -> dict[str, Column]:
    path, fields = f("path"), f("fields")
    place = F.get(F.filter(fields, lambda v: (v != "") & ~F.lower(v).isin("remote", "full time", "full time - remote")), F.lit(0))
    return _br(
        native_id=F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]*)$", 1), title=f("title"),
        company=F.lit("CloudWalk"), url=tx.absolute_url("https://www.cloudwalk.io/jobs", path), work_model=tx.work_model(F.array_join(fields, " ")),
        city=F.coalesce(place, F.lit("Brasil")), categories=F.array(F.lit("CloudWalk")),
    )


CARD_SPECS: dict[str, CardSpec] = {
    "experian": _path_jobs("https://jobs.experian.com", "more info", "Experian", contract="CLT"),
    "wise": _path_jobs("https://wise.jobs", "read more", "Wise", city="São Paulo", state="SP"),
    "recrutei": _vacancy_cards("recrutei", "https://jobs.recrutei.com.br"),
    "digisystem": _vacancy_cards("digisystem", "https://jobs.recrutei.com.br/digisystem"),
    "totvs": CardSpec(_CATALOG_CARD, _catalog_fields, _catalog, "all", element="div"),
    "nerdin": CardSpec(r"""(?i)<div[^>]*class=["'][^"']*vaga-card[^"']*["']""", _badge_fields, _badge_card, "last", before=True),
    "metalfrio": CardSpec(_DETAIL_CARD, _icon_fields, _icon_card, "all"),
    "nestle": CardSpec(r'(?is)<tr class="data-row">(.*?)</tr>', _table_fields, _table_row),
    "docusign": _listed("DocuSign", "Carreiras DocuSign", "https://careers.docusign.com/careers-home/jobs"),
    "dbccompany": _listed("DBC Company", "Carreiras DBC", "https://vagas.dbccompany.com.br/vagas"),
    "cloudwalk": CardSpec(_CMS_CARD, _cms_fields, _cms_card),
}

#: Rows of one portal carry another spelling of its name than the registry does.
ROW_SOURCE = {"nerdin": "Nerdin"}


def rows(landed: DataFrame, source: str, today: Column | None = None) -> DataFrame:
    """Canonical rows of one card portal, with ``page`` and ``item_ord``."""
    spec = CARD_SPECS[source]
    own = landed.filter(F.col("source") == source).withColumn("today", today if today is not None else dt.local_today())
    if "board" not in own.columns:
        own = own.withColumn("board", F.lit(None).cast("string"))
    cards = element_blocks(own, spec.element, spec.pattern) if spec.element else blocks(own, spec.pattern, spec.before)
    cards = cards.withColumns({f"_f_{name}": piece for name, piece in spec.fields(F.col("_card")).items()})
    mapped = cards.select(
        *canonical({**spec.map(_piece), "source": F.lit(ROW_SOURCE.get(source, source))}), "page", F.col("_pos").alias("item_ord")
    ).filter((F.col("title") != "") & (F.col("native_id") != ""))
    if spec.repeats == "all":
        return mapped
    return (keep_last if spec.repeats == "last" else keep_first)(mapped, ["native_id"], ["page", "item_ord"])
