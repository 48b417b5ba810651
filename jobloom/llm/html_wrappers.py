"""Main text of web pages through wrappers inferred per host.

A wrapper is a union-free regular expression over block tags: a sequence of elements, text slots, optional parts ``( )?`` and
repeated groups ``( )+``, nested as the tags are.  It starts as the tag stream of one page, in which runs of like neighbours are
folded into repeated groups, and is aligned with one stream after another of the same host: what both have stays, what only one
has becomes optional, a differing number of repeats becomes a repeated group, a differing text becomes a slot.

Distributed, streams are folded per page and made distinct per host; wrappers of chunks of at most CHUNK are aligned, then their
results, until each host has one, so no task ever holds all pages of a host.  Texts meet their slot (the path of tags) as
counts of the pages they stand on: a slot is template if each of its texts is on two different pages or more, and on half of the
pages that have the slot.  What one page alone has is content.

Each slot of a host's wrapper is marked content or template, and on every page the text is what stands in content slots.  Three
signs make the mark: standing under ``article`` or ``main``, an element name without doubt, and texts that are not template.  Two
of them make content; a page with an article gives only slots inside it, as what the page marks as article is.  So texts that all
articles share (a heading) stay, and an element in an article whose name raises doubt (``share``, ``notice``) goes if its texts
are template.  Pages without an article give their host's slots that are not template, or all if every such slot is.

Menus, page headers, footers, asides, forms, notices, adverts, comments, scripts and
styles are left out by tag, role, class or id; inside an article only by whole unambiguous names, and never a heading or section by
its id.  A form that encloses an article, or is the frame of a page without one, is not left out.

Null, empty or broken html: what text there is, else the empty string.  A null url is a host of its own.  Repeated pages give
repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import stage_table

#: Streams or wrappers that one task aligns.
CHUNK = 200
#: Share of the pages with a slot on which each of its texts must stand to be template.
TEMPLATE_SHARE = 0.5
#: Longest run of like neighbours that is folded.
FOLD = 4

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")
_NAME_PARTS = re.compile(r"[a-z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Tags whose content is part of the block around them.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
_DROPPED = frozenset("head script style noscript template nav footer aside button select option datalist fieldset dialog menu iframe object svg canvas audio video map math-menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
#: Words of a class or id that mark what is not the article; inside an article they only raise doubt.
_NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay sidebar side rail aside menu menus nav navbar navigation breadcrumb breadcrumbs masthead footer foot comment comments "
    "commentlist respond disqus reply replies discussion share sharing social related recommended recommendations newsletter subscribe subscription "
    "signup login search pagination pager toolbar widget widgets tags tagcloud skip".split()
)
#: Whole classes, roles or ids that mark it inside an article too.
_CLEAR_NOISE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adsbygoogle ad-banner ad-container ad-slot ad-unit ad-wrapper ads-wrapper banner-ad sponsored-content "
    "comment-form comments comments-area comment-list commentlist comment-section comments-section disqus disqus_thread respond cookie-banner cookie-bar cookie-consent cookie-notice "
    "share-bar sharebar share-buttons share-links social-share social-sharing sharedaddy sharing-buttons sidebar navbar nav-menu navigation breadcrumb breadcrumbs "
    "related-posts related-articles newsletter-signup newsletter-form subscribe-form pagination tagcloud tag-cloud skip-link".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a form that is the whole page holds, and a mere form does not.
_PROSE = re.compile(r"/(?:p|h[1-6]|li|td|blockquote|pre|dd)(?:\.[^/]*)?(?:/|\Z)")
#: Signs in a slot: of an element whose name raises doubt, and of one that begins an article by an attribute.
DOUBT, BEGINS = "!", "@"
#: Block tags that end an open paragraph, list item, row or cell.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table article main section div body html header footer nav aside form blockquote".split())


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): entities.unescape((v or "").strip("\"'")) for k, v in _ATTRIBUTE.findall(text)} if text.strip(" /") else {}


def _hidden(tag: str, given: dict[str, str]) -> bool:
    if tag in _DROPPED or "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "").lower() in _ROLES:
        return True
    return "none" in re.sub(r"\s", "", given.get("style", "")).partition("display:")[2][:4]


def _noise(tag: str, given: dict[str, str], in_article: bool) -> str:
    """``drop``, ``doubt`` (the element stays and its slots are marked) or nothing.  The id of a heading or section is its anchor
    and says nothing."""
    if _hidden(tag, given):
        return "drop"
    if tag in ("article", "main", "body", "html") and not in_article:
        return ""
    names = given.get("class", "").lower()
    if tag != "section" and tag not in _HEADINGS:
        names += " " + given.get("id", "").lower()
    words = set(_NAME_PARTS.findall(names))
    if in_article:
        return "drop" if _CLEAR_NOISE & set(names.split()) else "doubt" if words & _NOISE else ""
    return "drop" if words & _NOISE or tag == "header" or "header" in words else ""


def _signature(tag: str, given: dict[str, str]) -> str:
    names = sorted(set(_NAME_PARTS.findall(given.get("class", "").lower())))[:3]
    return ".".join([tag, *names])


def read_page(page: str) -> tuple[list[tuple[str, str, bool]], list]:
    """Blocks in page order as (slot, text, in_article), and the stream as nested [signature, children]."""
    root: list = ["", []]
    # open elements: tag, node, slot, dropped, in article, number of the form around it
    stack: list[tuple[str, list, str, bool, bool, int]] = [("", root, "", False, False, -1)]
    blocks: list[tuple[str, str, bool]] = []
    block_forms: list[int] = []
    forms: list[tuple[list, list, str]] = []  # outermost forms outside articles: node above, node, slot
    around: set[int] = set()  # forms that enclose an article
    held: list[str] = []

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", entities.unescape("".join(held))).strip()
            held.clear()
            _, node, slot, dropped, article, form = stack[-1]
            if text and not dropped:
                if not node[1] or node[1][-1][0] != "#":
                    node[1].append(["#", []])
                blocks.append((f"{slot}/#", text, article))
                block_forms.append(form)

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            if not stack[-1][3]:
                held.append(page[at:])
            break
        if found.start() > at and not stack[-1][3]:
            held.append(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        closing, tag = bool(found[1]), found[2].lower()
        if tag in _RAW and not closing:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else (size if tag in ("script", "style") else at)
            continue
        if tag in _INLINE:
            if tag in ("br", "wbr", "img") and not stack[-1][3]:
                held.append(" " if tag == "br" else "")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if closing:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "main", "body", "table") and tag in ("p", "li"):
                    break
            continue
        flush()
        given = _attributes(found[3])
        if stack[-1][0] == "p":
            stack.pop()
        if tag in _ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in _ENDS[tag]:
                    del stack[i:]
                    break
                if stack[i][0] in _SCOPES:
                    break
        _, node, slot, dropped, article, form = stack[-1]
        noise = _noise(tag, given, article)
        dropped = dropped or noise == "drop" or (tag == "form" and article)
        if tag in ("html", "body") and any(s[0] == tag for s in stack):
            continue
        begins = given.get("role") == "main" or given.get("itemprop") == "articleBody"
        child = [_signature(tag, given) + (DOUBT if noise == "doubt" else "") + (BEGINS if begins and not article else ""), []]
        if not dropped:
            node[1].append(child)
            if tag == "form" and form < 0:
                form = len(forms)
                forms.append((node, child, f"{slot}/{child[0]}"))
        article = article or tag in ("article", "main") or begins
        if article and not dropped:
            around.add(form)
        if not found[3].rstrip().endswith("/") or tag in ("p", "div"):
            stack.append((tag, child, f"{slot}/{child[0]}", dropped, article, form))
    flush()
    gone = set()
    for i, (above, node, slot) in enumerate(forms):
        if i not in around and not _is_page(i, slot, blocks, block_forms):
            gone.add(i)
            above[1][:] = [x for x in above[1] if x is not node]
    return ([b for b, form in zip(blocks, block_forms, strict=True) if form not in gone] if gone else blocks), root


def _is_page(form: int, slot: str, blocks: list[tuple[str, str, bool]], block_forms: list[int]) -> bool:
    """Whether a form without article is the frame of its page: directly in the body, with prose, and more text than outside."""
    if slot.count("/") - slot.startswith("/html/") - ("/body/" in slot or "/body." in slot) > 1 or any(article for _, _, article in blocks):
        return False
    inside = [(s, len(t)) for (s, t, _), f in zip(blocks, block_forms, strict=True) if f == form]
    return any(_PROSE.search(s[len(slot) :]) for s, _ in inside) and 2 * sum(n for _, n in inside) >= sum(len(t) for _, t, _ in blocks)




def fold(stream: list) -> dict:
    """The first wrapper of a stream: like neighbours become repeated groups."""
    items = [fold(child) for child in stream[1]]
    return {"k": stream[0], "c": fold_items(items)}


def _key(item: dict) -> str:
    return item["k"] if item["k"] != "(" else "(" + " ".join(_key(c) for c in item["c"])


def fold_items(items: list[dict]) -> list[dict]:
    for size in range(1, FOLD + 1):
        out: list[dict] = []
        at = 0
        while at < len(items):
            unit = items[at : at + size]
            names = [_key(u) for u in unit]
            end = at + size
            while len(unit) == size and [_key(u) for u in items[end : end + size]] == names:
                unit = [align(a, b) for a, b in zip(unit, items[end : end + size], strict=True)]
                end += size
            if end > at + size:
                out.append({**unit[0], "r": 1} if size == 1 else {"k": "(", "c": unit, "r": 1})
                at = end
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def align(left: dict, right: dict) -> dict:
    """The wrapper that covers two wrappers of the same element."""
    a, b = left["c"], right["c"]
    out = {"k": left["k"], "c": align_items(a, b)}
    for flag in ("r", "o"):
        if left.get(flag) or right.get(flag):
            out[flag] = 1
    return out


def align_items(a: list[dict], b: list[dict]) -> list[dict]:
    """Longest common subsequence by name; what only one side has becomes optional."""
    ka, kb = [_key(x) for x in a], [_key(x) for x in b]
    if ka == kb:
        return [align(x, y) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] == kb[j]:
            out.append(align(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append({**a[i], "o": 1})
            i += 1
        else:
            out.append({**b[j], "o": 1})
            j += 1
    return fold_items(out)


def slots(wrapper: dict, path: str = "") -> set[str]:
    """Paths of the text slots of a wrapper."""
    found: set[str] = set()
    for item in wrapper["c"]:
        if item["k"] == "#":
            found.add(f"{path}/#")
        else:
            found |= slots(item, path if item["k"] == "(" else f"{path}/{item['k']}")
    return found


def as_text(wrapper: dict) -> str:
    return json.dumps(wrapper, sort_keys=True, separators=(",", ":"))


BLOCKS = T.ArrayType(T.StructType([T.StructField("slot", T.StringType()), T.StructField("text", T.StringType()), T.StructField("article", T.BooleanType())]))
PAGE = T.StructType([T.StructField("blocks", BLOCKS), T.StructField("wrapper", T.StringType())])


@F.arrow_udf(PAGE)
def _pages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("blocks", pa.list_(pa.struct([("slot", pa.string()), ("text", pa.string()), ("article", pa.bool_())]))), ("wrapper", pa.string())])
    for batch in batches:
        rows = []
        for value in batch:
            blocks, stream = read_page(value.as_py() or "")
            rows.append({"blocks": [{"slot": s, "text": t, "article": a} for s, t, a in blocks], "wrapper": as_text(fold(stream))})
        yield pa.array(rows, kind)


def _aligned(table: pa.Table) -> pa.Table:
    """One wrapper from the wrappers of a chunk, in a fixed order."""
    texts = sorted(table["wrapper"].to_pylist())
    wrapper = json.loads(texts[0])
    for text in texts[1:]:
        wrapper = align(wrapper, json.loads(text))
    return pa.table({"host": table["host"].slice(0, 1), "wrapper": pa.array([as_text(wrapper)], pa.string())})


def infer(streams: DataFrame) -> DataFrame:
    """(host, wrapper) from any number of (host, wrapper) rows per host."""
    level = stage_table(streams.distinct(), "streams")
    while True:
        counts = level.groupBy("host").agg(F.count(F.lit(1)).alias("_n"))
        if (counts.agg(F.max("_n")).first()[0] or 0) <= 1:
            return level
        chunks = F.ceil(F.col("_n") / CHUNK).cast("long")
        dealt = level.join(counts, "host").select("host", "wrapper", F.pmod(F.xxhash64("wrapper"), chunks).alias("chunk"))
        level = stage_table(dealt.groupBy("host", "chunk").applyInArrow(_aligned, "host string, wrapper string").distinct(), "wrappers")


@F.arrow_udf(T.ArrayType(T.StringType()))
def _slots(wrappers: pa.Array) -> pa.Array:
    return pa.array([sorted(slots(json.loads(w.as_py()))) for w in wrappers], pa.list_(pa.string()))


def template_slots(pages: DataFrame) -> DataFrame:
    """(host, slot, template) of (host, blocks): template if every text of the slot stands on two different pages or more and on
    TEMPLATE_SHARE of the pages that have the slot."""
    page = pages.select("host", F.xxhash64("blocks").alias("page"), F.transform("blocks", lambda b: F.struct(b["slot"].alias("slot"), F.xxhash64(b["text"]).alias("h"))).alias("b"))
    # a row without a hash counts the pages of a slot
    slot_rows = F.transform("b", lambda b: F.struct(b["slot"].alias("slot"), F.lit(None).cast("long").alias("h")))
    rows = page.select("host", "page", F.inline(F.array_distinct(F.concat("b", slot_rows))))
    texts = rows.groupBy("host", "slot", "h").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("low"), F.max("page").alias("high"))
    is_text = F.col("h").isNotNull()
    by_slot = texts.groupBy("host", "slot").agg(
        F.max(F.when(~is_text, F.col("n"))).alias("pages"), F.min(F.when(is_text, F.col("n"))).alias("least"), F.min(F.when(is_text, F.col("low") != F.col("high"))).alias("spread")
    )
    return by_slot.select("host", "slot", (F.col("spread") & (F.col("least") >= TEMPLATE_SHARE * F.col("pages"))).alias("template"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text of the article, and the wrapper's number of text slots, for every page."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))
    read = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host.alias("host"), _pages.asNondeterministic()(F.col(html_col)).alias("_p"))
    wrappers = infer(read.select("host", F.col("_p.wrapper").alias("wrapper")))
    slot_table = wrappers.select("host", F.explode(_slots(F.col("wrapper"))).alias("slot"))
    # statistics are needed where the signs disagree: slots in doubt, and pages without an article
    doubtful = F.filter("_p.blocks", lambda b: F.contains(b["slot"], F.lit(DOUBT)))
    asked = read.select("host", F.when(F.exists("_p.blocks", lambda b: b["article"]), doubtful).otherwise(F.col("_p.blocks")).alias("blocks"))
    marks = slot_table.join(template_slots(asked.filter(F.size("blocks") > 0)), ["host", "slot"], "left")
    bare, template = ~F.contains("slot", F.lit(DOUBT)) & F.col("template").isNotNull(), F.coalesce("template", F.lit(False))
    known = marks.groupBy("host").agg(
        F.count(F.lit(1)).alias("wrapper_slots"),
        F.collect_set(F.when(~template, F.col("slot"))).alias("_content"),  # at most the slots of one wrapper
        F.collect_set(F.when(bare & template, F.col("slot"))).alias("_alone"),
        F.coalesce(F.max(bare & ~template), F.lit(False)).alias("_some"),
    )
    # where every slot outside articles is template, they are all there is
    known = known.select("host", "wrapper_slots", F.when(F.col("_some"), F.col("_content")).otherwise(F.array_union("_content", "_alone")).alias("_content"))
    rows = read.join(known, "host", "left")
    blocks = F.col("_p.blocks")
    in_article = F.exists(blocks, lambda b: b["article"])
    chosen = F.filter(blocks, lambda b: (b["article"] | ~in_article) & F.array_contains(F.col("_content"), b["slot"]))
    text = F.array_join(F.transform(F.coalesce(chosen, blocks), lambda b: b["text"]), "\n")
    return rows.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), text.alias("text"), F.coalesce("wrapper_slots", F.lit(0)).alias("wrapper_slots"))
