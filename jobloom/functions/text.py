"""Text functions: Column -> Column, all native expressions.

Three different folds coexist on purpose, because keys built with one must not be compared with keys built with
another:

* ``fold_ascii``     decompose, drop every non-ASCII character, lower-case        (classification, equivalence keys)
* ``fold_caseless``  case-fold, drop combining marks, dashes to ``-``, squeeze     (requirement extraction)
* ``fold_search``    drop combining marks, lower-case, trim                        (faceted search, staging)
  ``fold_resume``    the same plus dashes and squeezed white space                 (scoring)
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import folding

#: White space as Unicode text processing sees it; Java's ``\s`` alone is ASCII only.
_UNICODE_BLANKS = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
WS = r"[\s\x1c-\x1f" + "".join(map(chr, _UNICODE_BLANKS)) + "]"
_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f" + "".join(map(chr, _UNICODE_BLANKS))
#: What ``squeeze`` has to change: runs of two or more, and single ones other than the blank.  The ASCII form is far cheaper to scan.
_UNEVEN = rf"{WS}{{2,}}|[\t-\r\x1c-\x1f" + "".join(map(chr, _UNICODE_BLANKS)) + "]"
_RARE_BLANKS = ",".join(map(chr, _UNICODE_BLANKS))
_UNEVEN_ASCII = r"[\t-\r\x1c-\x20]{2,}|[\t-\r\x1c-\x1f]"
#: A blank beyond ASCII; the first range lets ASCII pass at once.
RARE_BLANK = r"[\x80-\uffff&&[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]]"


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---------------------------------------------------------------- blanks and white space


def strip(c: Column | str) -> Column:
    return F.btrim(_c(c), F.lit(_BLANKS))


def _squeeze_ascii(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _UNEVEN_ASCII, " "))


def squeeze(c: Column | str) -> Column:
    """Every run of white space becomes one blank, ends trimmed."""

    def squeezed(t: Column) -> Column:
        others = F.regexp_extract_all(t, F.lit(folding.BEYOND_ASCII), F.lit(0))
        rare = ~_is_ascii(t) & F.arrays_overlap(F.array_distinct(others), F.split(F.lit(_RARE_BLANKS), ","))
        return F.when(rare, F.trim(F.regexp_replace(t, _UNEVEN, " "))).otherwise(_squeeze_ascii(t))

    return once(_c(c), squeezed)


def blank_to_null(c: Column | str) -> Column:
    """NULL for NULL, empty and white-space-only text; anything else trimmed."""
    return F.nullif(strip(c), F.lit(""))


def first_non_blank(*columns: Column | str) -> Column:
    """First of several columns that carries text, or the empty string."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in columns], F.lit(""))


def text_or_blank(c: Column | str) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def once(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated a single time, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


# ---------------------------------------------------------------- folds


def _is_ascii(c: Column) -> Column:
    # one byte per character; far cheaper than scanning with a pattern
    return F.octet_length(c) == F.char_length(c)


def fold_ascii(c: Column | str) -> Column:
    def fold(t: Column) -> Column:
        plain = F.regexp_replace(folding.replaced(t, folding.to_ascii, drops_rest=True), r"[^\x00-\x7F]", "")
        return F.lower(F.when(_is_ascii(t), t).otherwise(plain))

    return once(text_or_blank(c), fold)


def fold_caseless(c: Column | str) -> Column:
    return once(F.lower(text_or_blank(c)), lambda t: _squeeze_ascii(F.when(_is_ascii(t), t).otherwise(folding.replaced(t, folding.to_caseless))))


def fold_search(c: Column | str) -> Column:
    return once(text_or_blank(c), lambda t: strip(F.lower(F.when(_is_ascii(t), t).otherwise(folding.replaced(t, folding.to_unaccented)))))


def collation_key(c: Column | str) -> Column:
    """Text order without case and accents in which runs of digits compare as numbers, before letters.

    A run becomes its length without leading zeros, in five digits, and its digits.
    """
    folded = fold_search(c)
    digits = lambda run: F.ltrim(run, F.lit("0"))
    number = lambda run: F.concat(F.lpad(F.length(digits(run)).cast("string"), 5, "0"), digits(run))
    runs = lambda t: F.regexp_extract_all(t, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    spelled = lambda t: F.array_join(F.transform(runs(t), lambda run: F.when(run.rlike("^[0-9]"), number(run)).otherwise(run)), "")
    return once(folded, lambda t: F.when(t.rlike("[0-9]"), spelled(t)).otherwise(t))


def fold_resume(c: Column | str) -> Column:
    return once(text_or_blank(c), lambda t: _squeeze_ascii(F.lower(F.when(_is_ascii(t), t).otherwise(folding.replaced(t, folding.to_comparable)))))


def equivalence_text(c: Column | str) -> Column:
    """Folded text without level, modality and number words, words separated by one blank."""
    without = F.regexp_replace(fold_ascii(c), fx.EQUIVALENCE_STOP, " ")
    return F.trim(F.regexp_replace(without, "[^a-z0-9]+", " "))


# ---------------------------------------------------------------- HTML


def _entity_names(names: dict[str, str]) -> Column:
    # one foldable expression, however long the table is
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _code_point(number: Column) -> Column:
    """The character for a code point; invalid ones become U+FFFD."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    padded = F.lpad(F.hex(F.when(valid, number).otherwise(F.lit(0xFFFD))), 8, "0")
    return F.decode(F.unhex(padded), "UTF-32")


_WINDOWS_1252 = {
    code: bytes([code]).decode("cp1252") for code in range(0x80, 0xA0) if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
}
_COMMON = {name: html.entities.html5[f"{name};"] for name in ("amp", "lt", "gt", "quot", "apos")}
_HTML5 = {name[:-1]: value for name, value in html.entities.html5.items() if name.endswith(";")}
_UNTERMINATED = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)


def _unescape_piece(piece: Column, names: Column, numeric: str, windows: bool) -> Column:
    """Resolve the entity that starts right after an ampersand; ``piece`` is the text up to the next ampersand."""
    digits = F.regexp_extract(piece, numeric, 1)
    is_hex = digits.rlike("^[xX]")
    number = F.when(
        is_hex, F.conv(F.substring(digits, 2, 16), 16, 10).try_cast("bigint")
    ).otherwise(digits.try_cast("bigint"))
    number = F.coalesce(number, F.lit(0x110000).cast("bigint"))
    rest_numeric = F.regexp_replace(piece, numeric, "")
    char = _code_point(number)
    if windows:
        legacy = _entity_names({str(code): value for code, value in _WINDOWS_1252.items()})
        char = F.coalesce(F.try_element_at(legacy, number.cast("string")), char)
    name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*);", 1)
    value = F.coalesce(F.try_element_at(_entity_names(_COMMON), name), F.try_element_at(names, name))
    resolved = (
        F.when(digits != "", F.concat(char, rest_numeric))
        .when((name != "") & value.isNotNull(), F.concat(value, F.regexp_replace(piece, "^[A-Za-z][A-Za-z0-9]*;", "")))
    )
    if windows:  # HTML5 also accepts a fixed set of names without the semicolon
        pattern = f"^({'|'.join(_UNTERMINATED)})"
        short = F.regexp_extract(piece, pattern, 1)
        resolved = resolved.when(
            short != "", F.concat(F.try_element_at(names, short), F.regexp_replace(piece, pattern, ""))
        )
    return resolved.otherwise(F.concat(F.lit("&"), piece))


def _unescape(c: Column, names: dict[str, str], numeric: str, windows: bool) -> Column:
    table = _entity_names(names)

    def resolve(text: Column) -> Column:
        pieces = F.split(text, "&")
        rest = F.transform(
            F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
            lambda p: _unescape_piece(p, table, numeric, windows),
        )
        return F.when(F.instr(text, "&") == 0, text).otherwise(F.concat(pieces[0], F.array_join(rest, "")))

    return once(c, resolve)


def unescape(c: Column | str) -> Column:
    """Resolve HTML5 character references."""
    return _unescape(_c(c), _HTML5, r"^#([0-9]+|[xX][0-9a-fA-F]+);?", windows=True)


def strip_html(c: Column | str, limit: int = 6000) -> Column:
    def joined(t: Column) -> Column:
        # the class of all blanks is slow to scan for; few texts hold one beyond ASCII
        return F.when(t.rlike(RARE_BLANK), F.regexp_replace(t, rf"{WS}{{2,}}", " ")).otherwise(F.regexp_replace(t, r"[\t-\r\x1c-\x20]{2,}", " "))

    text = unescape(F.regexp_replace(text_or_blank(c), "<[^>]+>", " "))
    return F.substring(strip(once(text, joined)), 1, limit)


def decode_html(c: Column | str) -> Column:
    """Tags to blanks, block ends to line breaks, a fixed entity set resolved, blanks squeezed per line."""
    text = F.regexp_replace(text_or_blank(c), r"(?i)<\s*br\s*/?\s*>", "\n")
    text = F.regexp_replace(text, r"(?i)</(p|li|div|h[1-6]|ul|ol)>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", " ")
    text = _unescape(text, fx.STAGING_ENTITIES, r"(?i)^#([0-9]+|x[0-9a-f]+);", windows=False)
    text = F.regexp_replace(text, r"[\t\r ]+", " ")
    return strip(F.regexp_replace(text, r" *\n+ *", "\n"))


def clean_text(c: Column | str, limit: int = 500) -> Column:
    no_controls = F.regexp_replace(text_or_blank(c), r"[\x00-\x1F\x7F]", " ")
    return F.substring(squeeze(no_controls), 1, limit)


# ---------------------------------------------------------------- URLs and slugs


def slugify(c: Column | str) -> Column:
    spelled = F.replace(fold_search(c), F.lit("&"), F.lit(" e "))
    slug = F.regexp_replace(F.regexp_replace(spelled, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("vaga"))


def title_slug(c: Column | str, limit: int = 120) -> Column:
    slug = F.regexp_replace(F.regexp_replace(fold_ascii(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    cut = F.regexp_replace(F.substring(slug, 1, limit), "-+$", "")
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("vaga"))


def plain_slug(c: Column | str) -> Column:
    """Slug without accent folding (accented letters become separators)."""
    return F.regexp_replace(F.regexp_replace(F.lower(text_or_blank(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def percent_encode(c: Column | str) -> Column:
    """Percent-encode everything outside the unreserved set (blank becomes ``%20``)."""
    encoded = F.url_encode(text_or_blank(c))
    for have, want in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(have), F.lit(want))
    return encoded


def canonical_url(c: Column | str) -> Column:
    return F.regexp_replace(text_or_blank(c), r"[?#][\s\S]*$", "")


def https_url(c: Column | str) -> Column:
    """The first ``http://`` becomes ``https://``."""
    c = text_or_blank(c)
    at = F.instr(c, "http://")
    swapped = F.concat(F.substring(c, F.lit(1), at - 1), F.lit("https://"), F.substring(c, at + 7, F.length(c)))
    return F.when(at > 0, swapped).otherwise(c)


def absolute_url(base: str, href: Column | str) -> Column:
    """Resolve an href against a page URL: absolute, protocol-relative, host-relative or path-relative."""
    root = "/".join(base.split("/")[:3])
    folder = base.split("?")[0].split("#")[0]
    folder = folder.rsplit("/", 1)[0] + "/" if folder.count("/") > 2 else folder + "/"
    href = text_or_blank(href)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(base.split(":")[0] + ":"), href))
        .when(href.startswith("/"), F.concat(F.lit(root), href))
        .when(href == "", F.lit(base))
        .otherwise(F.concat(F.lit(folder), href))
    )


def last_path_segment(c: Column | str) -> Column:
    trimmed = F.regexp_replace(text_or_blank(c), "/+$", "")
    return F.regexp_replace(F.regexp_extract(trimmed, r"([^/]*)$", 1), r"\?[\s\S]*$", "")


# ---------------------------------------------------------------- labels


def _has_any(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | c.contains(word)
    return out


def work_model(raw: Column | str, remote_flag: Column | None = None) -> Column:
    """``remote`` / ``hybrid`` / ``on-site`` / blank; an explicit flag wins, then remote, hybrid, on-site words."""
    text = F.lower(text_or_blank(raw))
    flag = F.coalesce(remote_flag, F.lit(False)) if remote_flag is not None else F.lit(False)
    return (
        F.when(flag | _has_any(text, fx.REMOTE_WORDS), "remote")
        .when(_has_any(text, fx.HYBRID_WORDS), "hybrid")
        .when(_has_any(text, fx.ON_SITE_WORDS), "on-site")
        .otherwise("")
    )


def lookup(table: dict[str, str], key: Column) -> Column:
    """Literal map lookup; NULL when the key is absent."""
    return F.try_element_at(_entity_names(table), key)


def source_label(c: Column | str) -> Column:
    c = text_or_blank(c)
    return F.coalesce(lookup(fx.SOURCE_LABELS, c), F.nullif(c, F.lit("")), F.lit(fx.SOURCE_LABEL_BLANK))


def workplace_label(c: Column | str) -> Column:
    key = fold_search(c)
    return (
        F.when(key.isin("remote", "remoto"), "Remoto")
        .when(key.isin("hybrid", "hibrido"), "Híbrido")
        .when(key.isin("on-site", "onsite", "presencial"), "Presencial")
        .otherwise("Não informada")
    )


def market_label(c: Column | str) -> Column:
    c = text_or_blank(c)
    return F.coalesce(lookup(fx.MARKET_LABELS, c), F.nullif(c, F.lit("")), F.lit(fx.UNKNOWN_MARKET))


def contract_label(c: Column | str) -> Column:
    c = text_or_blank(c)
    return F.when(fold_search(c) == "pj", "CNPJ").otherwise(c)


# ---------------------------------------------------------------- places


def _parts(c: Column, separator: str) -> Column:
    return F.filter(F.transform(F.split(text_or_blank(c), separator), strip), lambda p: p != "")


def split_location(c: Column | str) -> Column:
    """``city, state, country`` struct; state and country only when they look like short codes."""
    parts = _parts(_c(c), ",")
    n = F.size(parts)
    last, before = F.get(parts, n - 1), F.get(parts, n - 2)
    return F.struct(
        F.coalesce(F.get(parts, F.lit(0)), F.lit("")).alias("city"),
        F.when((n >= 3) & (F.length(before) <= 3), before).otherwise("").alias("state"),
        F.when((n >= 2) & (F.length(last) <= 3), last).otherwise("").alias("country"),
    )


def city_names(c: Column | str) -> Column:
    """City names of a display location such as ``Recife, PE · Olinda``, without country-like words."""
    pieces = _parts(_c(c), rf"{WS}+[·|;]{WS}+")
    first = F.transform(
        pieces, lambda p: F.regexp_replace(strip(F.split(p, ",")[0]), r"(?i)^(?:br|us|usa)\s*-\s*", "")
    )
    return F.filter(first, lambda p: (p != "") & ~fold_search(p).isin(*fx.GENERIC_CITY_WORDS))


def title_case(c: Column | str) -> Column:
    """Upper-case-only text becomes title case per run of letters; a few city names regain their accent."""
    text = squeeze(text_or_blank(c))
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    cased = F.when(text == F.upper(text), F.array_join(F.transform(runs, F.initcap), "")).otherwise(text)
    accents = {plain.lower(): accented for plain, accented in fx.LOCATION_ACCENTS.items()}
    return F.coalesce(lookup(accents, F.lower(cased)), cased)


def tidy_location(c: Column | str) -> Column:
    """``SAO PAULO, SP, Brasil`` becomes ``São Paulo, SP``."""
    parts = _parts(_c(c), ",")
    n = F.size(parts)
    ends_in_country = (n > 0) & F.lower(F.get(parts, n - 1)).isin(*fx.BRAZIL_CODES)
    kept = F.when(ends_in_country, F.slice(parts, 1, F.greatest(n - 1, F.lit(0)))).otherwise(parts)
    state = F.get(kept, F.lit(1))
    city = title_case(F.get(kept, F.lit(0)))
    return (
        F.when(F.size(kept) == 0, "")
        .when(F.coalesce(F.length(state) <= 3, F.lit(False)), F.concat(city, F.lit(", "), F.upper(state)))
        .otherwise(city)
    )


def board_location(c: Column | str, title: Column | str) -> Column:
    """Location of a career-board row without a leading workplace word; falls back to ``| City / UF`` in the title."""
    text = F.regexp_replace(squeeze(text_or_blank(c)), fx.WORKPLACE_PREFIX, "")
    parts = F.array_distinct(_parts(text, r"(?U)\s*[;|]\s*"))
    pattern = r"\|\s*([A-Za-zÀ-ÿ .'-]+?)\s*/\s*([A-Z]{2})\b"
    city, state = (F.regexp_extract(text_or_blank(title), pattern, g) for g in (1, 2))
    usable = (state != "") & ~F.lower(strip(city)).isin("híbrido", "hibrido", "presencial", "remoto")
    return (
        F.when(F.size(parts) > 0, F.array_join(parts, " · "))
        .when(usable, F.concat_ws(", ", strip(city), state))
        .otherwise("")
    )


def company_from_slug(c: Column | str) -> Column:
    slug = F.lower(strip(text_or_blank(c)))
    words = F.filter(F.split(F.regexp_replace(slug, r"-\d+$", ""), "-"), lambda w: w != "")
    capital = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w)))))
    return (
        F.when(slug.isin(*fx.CONFIDENTIAL_SLUGS), fx.COMPANY_CONFIDENTIAL)
        .when(F.size(capital) > 0, F.array_join(capital, " "))
        .otherwise(fx.COMPANY_BLANK)
    )


# ---------------------------------------------------------------- CSV, flags, contracts


def csv_cell(c: Column | str) -> Column:
    """Quoted cell; text a spreadsheet would read as a formula gets a leading apostrophe."""
    text = text_or_blank(c)
    safe = F.when(text.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)
    return F.concat(F.lit('"'), F.replace(safe, F.lit('"'), F.lit('""')), F.lit('"'))


def matches(c: Column | str, pattern: str) -> Column:
    return text_or_blank(c).rlike(pattern)


def labels_in_text(c: Column | str, table: tuple[tuple[str, str], ...]) -> Column:
    """Labels whose pattern occurs, in table order."""
    text = text_or_blank(c)
    return F.array_compact(F.array(*[F.when(text.rlike(pattern), label) for label, pattern in table]))


def first_label(c: Column, table, otherwise: str) -> Column:
    """Label of the first pattern that matches."""
    out = None
    for label, pattern in table:
        out = F.when(c.rlike(pattern), label) if out is None else out.when(c.rlike(pattern), label)
    return out.otherwise(otherwise)


def split_alternatives(c: Column | str) -> Column:
    """``CLT ou PJ`` becomes ``[CLT, PJ]``; blank becomes an empty list."""
    return F.filter(F.transform(F.split(text_or_blank(c), r"(?iuU)\s+ou\s+"), strip), lambda p: p != "")


# ---------------------------------------------------------------- aliases


def regex_quote(text: str) -> str:
    return "".join("\\" + ch if ch in r".+*?^$(){}[]|\/-" else ch for ch in text)


def py_fold_caseless(value: str) -> str:
    """Driver-side twin of ``fold_caseless`` for short vocabulary literals."""
    return " ".join(folding.to_caseless(value or "").split())


def needs_boundary(alias: str) -> bool:
    """Short aliases and those with technical punctuation only count as whole words."""
    return len(alias) <= 4 or any(ch in alias for ch in ".#+/-")


def alias_regex(alias: str) -> str:
    """Pattern for a folded alias inside a folded advertisement."""
    if not needs_boundary(alias):
        return regex_quote(alias)
    left = "a-z0-9/" if alias == "sql" else "a-z0-9"
    return f"(?<![{left}]){regex_quote(alias)}(?![a-z0-9])"


def resume_alias_regex(alias: str) -> str:
    """Pattern for a folded alias inside a folded résumé; here ``pl/sql`` does count as ``sql``."""
    if alias == "sql":
        return r"(?<![a-z0-9])(?:sql|pl/sql|plsql)(?![a-z0-9])"
    if not needs_boundary(alias):
        return regex_quote(alias)
    return f"(?<![a-z0-9]){regex_quote(alias)}(?![a-z0-9])"


def has_alias(text: Column, alias: str, regex=alias_regex) -> Column:
    """Alias test on folded text.  The substring test runs first because it is cheap and usually false."""
    if not alias:
        return F.lit(False)
    found = text.contains(alias)
    if alias == "sql" and regex is resume_alias_regex:
        return found & text.rlike(regex(alias))
    return found & text.rlike(regex(alias)) if needs_boundary(alias) else found
