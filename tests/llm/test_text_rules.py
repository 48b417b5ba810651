"""Secrets, quality votes, HTML wrappers, licences and tool calls."""

import random
import base64
import bz2
import collections
import gzip
import json
import lzma
import pathlib
import re
import urllib.parse
import zlib

import numpy as np
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pyarrow as pa
from jobloom.llm import html_wrappers, licenses, quality_votes, secrets, tool_calls

from .helpers import AWKWARD, documents

KEY = "password=abcdefgh12"


def plain_base(text):
    """The base findings, straight from their definition."""
    found = []
    for m in re.finditer(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


PARTS = st.sampled_from(["password", "Token", "ſecret", "api_key", "APIKEY", "=", ":", " ", '"', "abcdefgh", "AKIA", "ABCDEFGHIJKLM", "0123456789abcdef", "f", "_", "\n", "é", "%41", "\\u0041", "=="])


@settings(max_examples=500, deadline=None)
@given(parts=st.lists(PARTS, max_size=14))
def test_base_secrets(parts):
    text = "".join(parts)
    base = [(a, secrets.KINDS.index(k), b) for k, a, b, is_base in secrets.find_secrets(text)[0] if is_base]
    assert base == plain_base(text)


def test_layers_behind_odd_bytes_surrogates_and_paths():
    percent = "%E9" + "".join(f"%{b:02X}" for b in KEY.encode()) + "%FF"
    escaped = "\\ud800" + "".join(f"\\u{ord(c):04x}" for c in KEY)
    once = base64.b64encode(KEY.encode()).decode()
    for wrapped in (percent, escaped, *(f"/{'e' * k}/{once}" for k in range(5)), *("x" * k + once for k in range(4))):
        found = secrets.find_secrets(f"see {wrapped} end")[0]
        assert any(kind == "assign" and not is_base and 3 <= a < b <= 4 + len(wrapped) for kind, a, b, is_base in found), wrapped


WRAPPERS = {
    "percent": lambda t: "".join(f"%{b:02x}" for b in t.encode()), "odd percent": lambda t: "%ff" + "".join(f"%{b:02X}" for b in t.encode()),
    "escape": lambda t: "".join(f"\\u{ord(c):04x}" for c in t), "base64": lambda t: base64.b64encode(t.encode()).decode(),
    "url base64": lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("="), "path": lambda t: "/etc/" + base64.b64encode(t.encode()).decode(),
    "gzip": lambda t: base64.b64encode(gzip.compress(t.encode())).decode(), "zlib": lambda t: base64.b64encode(zlib.compress(t.encode())).decode(),
    "bz2": lambda t: base64.b64encode(bz2.compress(t.encode())).decode(), "utf-16": lambda t: base64.b64encode(t.encode("utf-16")).decode(),
    "words": lambda t: f"and then {t} so",
}


@settings(max_examples=150, deadline=None)
@given(names=st.lists(st.sampled_from(sorted(WRAPPERS)), min_size=1, max_size=5))
def test_a_secret_is_found_under_any_nesting(names):
    text = KEY
    for name in names:
        text = WRAPPERS[name](text)
    found = secrets.find_secrets(f"before {text} after")[0]
    assert any(kind == "assign" for kind, *_ in found), names


def test_nested_layers_map_to_the_text():
    once = base64.b64encode(KEY.encode()).decode()
    twice = base64.b64encode(gzip.compress(once.encode())).decode()
    for wrapped in (once, twice, urllib.parse.quote(once), "".join(f"\\u{ord(c):04x}" for c in KEY), "".join(f"%{b:02X}" for b in KEY.encode())):
        text = f"before {wrapped} after"
        found = [text[a:b] for k, a, b, base in secrets.find_secrets(text)[0] if k == "assign"]
        assert wrapped in found and all(wrapped.startswith(x) for x in found)  # a run also decodes without its quoted padding
        assert secrets.redact(text) == "before [assign] after"
    assert secrets.find_secrets("tok%65n%3Dabcdefghijk")[0] == [("assign", 0, 21, False)]


def test_layers_end_on_cycles_and_bombs(monkeypatch):
    assert secrets.find_secrets("%25" * 50 + "41")[1] < 60
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1000)
    assert secrets.find_secrets(base64.b64encode(gzip.compress(b"a" * 5000)).decode())[2] == 1


def kinds(text):
    return {k for k, _, _, _ in secrets.find_secrets(text)[0]}


def test_layers_are_read_whatever_they_hold():
    """Signs that do not print, other encodings, binary data around, and several members."""
    key = KEY.encode()
    rng = np.random.default_rng(3)
    members = [t(b"plain words ") + t(key) for t in (gzip.compress, bz2.compress, lzma.compress, zlib.compress, zstandard.ZstdCompressor().compress)]
    for data in (*[(c + KEY).encode() for c in "\u00a0\ufeff\u200b\u200d\u00ad\u3000\0"], *[KEY.encode(k) for k in ("utf-16", "utf-16-le", "utf-16-be")], b"\xe9 " + key, rng.bytes(51) + b" " + key, b"x" + KEY.encode("utf-16-le"), *members, gzip.compress(b"a") + b"\n" + key):
        text = f"before {base64.b64encode(data).decode()} after"
        assert kinds(text) == {"assign"} and secrets.redact(text) == "before [assign] after", data


def test_wrapped_base64_is_joined():
    data = gzip.compress(np.random.default_rng(5).bytes(400) + b" " + KEY.encode())
    for width, gap in ((76, "\n"), (64, "\r\n"), (76, "\n    ")):
        run = base64.b64encode(data).decode()
        run = gap.join(run[i : i + width] for i in range(0, len(run), width))
        for text in (f"key:\n{run}\nend of it", f'"{run}"', f"internationalisation\n{run}\n"):
            assert kinds(text) == {"assign"} and run not in secrets.redact(text)
        assert secrets.redact(f"key: {run}\nend of it") == "key: [assign]\nend of it"


def test_large_layers_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1000)
    monkeypatch.setattr(secrets, "OVERLAP_BYTES", 100)
    for before in (b"some words, " * 700, b"z" * 7777 + b" "):
        packed = gzip.compress(gzip.compress(before + KEY.encode() + b" " + before))
        assert kinds(base64.b64encode(packed).decode()) == {"assign"}
    assert secrets.find_secrets(base64.b64encode(gzip.compress(b"some words, " * 700)).decode())[2] == 0


def test_secret_columns(spark):
    docs = documents(spark, [*AWKWARD, f"a {KEY} b", f"a {KEY} b"])
    rows = docs.select("doc_id", secrets.secrets_column(F.col("text")).alias("f"), secrets.redacted_column(F.col("text")).alias("r"), "text").orderBy("doc_id").collect()
    assert [len(r["f"]["spans"]) for r in rows] == [0] * len(AWKWARD) + [1, 1]
    assert rows[0]["r"] is None and rows[1]["r"] == "" and rows[-1]["r"] == "a [assign] b" and rows[8]["r"] == rows[8]["text"]


def plain_signals(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


@settings(max_examples=300, deadline=None)
@given(words=st.lists(st.sampled_from(["a", "b", "c#", "é|", "\n", "\t", "\x1c", "日"]), max_size=30))
def test_signals(words):
    text = " ".join(words)
    assert quality_votes.signals(text)[:5] == plain_signals(text)


def test_votes_estimate_accuracies():
    """Votes drawn from known accuracies: the posterior finds the hidden class without labels."""
    rng = np.random.default_rng(5)
    good = rng.random(6000) < 0.8
    right_good, right_bad = np.linspace(0.96, 0.999, 10), np.linspace(0.4, 0.9, 10)
    vote = np.where(good[:, None], np.where(rng.random((6000, 10)) < right_good, 1, -1), np.where(rng.random((6000, 10)) < right_bad, -1, 1))
    vote[rng.random(vote.shape) < 0.2] = 0
    model = quality_votes.VoteModel().fit(collections.Counter(map(tuple, vote.tolist())))
    assert ((model.posterior(vote) >= 0.5) == good).mean() > 0.97
    assert abs(model.share - 0.8) < 0.03 and abs(model.bad[0] - 0.6) < 0.1


def test_posterior_column_equals_the_model(spark):
    model = quality_votes.VoteModel().fit({(1,) * 10: 90, (-1,) * 10: 10})
    table = spark.createDataFrame([([1] * 10,), ([-1] * 10,), ([0] * 10,), ([1, -1] * 5,)], "votes array<int>")
    got = [r[0] for r in table.select(model.posterior_column(F.col("votes"))).collect()]
    assert np.allclose(got, model.posterior(np.array([[1] * 10, [-1] * 10, [0] * 10, [1, -1] * 5])))
    assert quality_votes.fit(table.limit(0)).share == 0.8


def test_junk_goes_and_prose_stays(spark):
    rng = np.random.default_rng(7)
    parts = ["mar", "lo", "ven", "ti", "qua", "res", "do", "pel"]

    def prose():
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(150)]
        return "\n".join(" ".join(words[k : k + 10]).capitalize() + "." for k in range(0, 150, 10))

    docs = documents(spark, [*[prose() for _ in range(40)], "spam " * 200, "!!! ".join(["BUY"] * 90), *[" | ".join(f"c{i}{j}" for i in range(80)) for j in range(6)], *AWKWARD])
    s = docs.select("doc_id", quality_votes.signals_column(F.col("text")).alias("s")).select("doc_id", quality_votes.votes(F.col("s")).alias("votes"), quality_votes.base_failed(F.col("s")).alias("base"))
    model = quality_votes.fit(s)
    kept = {r[0] for r in s.filter(~F.col("base") & (model.posterior_column(F.col("votes")) >= quality_votes.KEEP)).collect()}
    assert set(range(40)) <= kept and not kept & set(range(40, 56))


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var a="</p>";</script></head><body>
<div id="cookie-notice"><p>We use cookies</p></div><header><h1>Site</h1></header><nav><ul><li><a href=1>Home</a></ul></nav>
<article><h1>Title &amp; more</h1><p>First   <b>bold</b>&nbsp;text<p>Second.<!-- gone --><ul><li>one<li>two</ul>
<div class="ad">Buy</div><form><p>Mail</p></form><section class="comments"><p>Nice!</p></section></article>
<aside><p>Related</p></aside><footer>&copy; us</footer></body></html>"""


def text_of(page):
    return "\n".join(t for _, t, article in html_wrappers.read_page(page)[0] if article)


def test_article_of_a_page():
    assert text_of(PAGE) == "Title & more\nFirst bold text\nSecond.\none\ntwo"
    for broken in ("<p", "<", "a < b", "<div class='x", "<script>", "<!--", "</p></p>", "&#xZZ;", "<p a=\"'>\">x"):
        html_wrappers.read_page(broken)


def test_names_inside_an_article_do_not_drop_it():
    kept = "<section id='discussion'><h2 id='related-work'>A</h2></section><div class='notice'>B</div><div class='social-impact'><p>C</p></div><h2 id='side-effects'>D</h2>"
    dropped = "<div class='share-bar'>x</div><div class='ad box'>x</div><div id='comments'>x</div><form><p>x</p></form>"
    article = f"<article>{kept}{dropped}</article>"
    assert text_of(f"<body>{article}</body>") == "A\nB\nC\nD"
    assert text_of(f"<body><form id=f><div>{article}</div></form><form><p>Mail</p></form></body>") == "A\nB\nC\nD"


def test_form_around_a_page_without_article():
    def texts(page):
        return [t for _, t, _ in html_wrappers.read_page(page)[0]]

    assert texts("<html><body class=b><form action=x><div><p>Long story</p></div></form><p>foot</p></body></html>") == ["Long story", "foot"]
    assert texts("<body><p>Story</p><form>Name <input></form><div><form><p>Write to us, we answer soon</p></form></div></body>") == ["Story"]


def test_wrappers_align():
    def wrapper(page):
        return html_wrappers.fold(html_wrappers.read_page(page)[1])

    one, two = wrapper("<body><h1>a</h1><p>b</p><p>c</p><p>d</p></body>"), wrapper("<body><h1>a</h1><div>x</div><p>b</p></body>")
    both = html_wrappers.align(one, two)["c"][0]["c"]
    assert [(x["k"], x.get("o", 0), x.get("r", 0)) for x in both] == [("h1", 0, 0), ("div", 1, 0), ("p", 0, 1)]
    pairs = wrapper("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>")["c"][0]["c"]
    assert [x["k"] for x in pairs] == ["("] and pairs[0]["r"] == 1
    assert html_wrappers.slots(html_wrappers.align(one, two)) == {"/body/h1/#", "/body/p/#", "/body/div/#"}


def test_extraction_over_hosts(spark, monkeypatch):
    monkeypatch.setattr(html_wrappers, "CHUNK", 3)
    bare = "<body><div class='top'>Our shop</div><div class='text'><p>Story {}</p>{}</div></body>"
    rows = [(i, "http://a.org/x", bare.format(i, "<p>more</p>" * (i % 4) + "<h2>h</h2>" * (i % 3)), "clash") for i in range(12)]
    rows += [(20, "http://b.org", PAGE, ""), (21, None, PAGE, ""), (22, "http://b.org", None, ""), (23, "http://b.org", "", ""), (24, "http://c.org", "<body><p>alone</p></body>", ""), (25, "http://c.org", "<body><p>alone</p></body>", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in html_wrappers.extract(pages).collect()}
    assert len(got) == len(rows) and got[20] == got[21] == text_of(PAGE) and got[22] == got[23] == "" and got[24] == got[25] == "alone"
    assert got[4] == "Story 4"  # the line all pages share is template
    assert html_wrappers.extract(pages.limit(0)).count() == 0


def test_slots_of_one_page_stay(spark):
    """A block that one page of a host has is content; texts that all pages repeat are template, also several in one slot."""
    page = "<body><div class='top'>Our shop</div><ul><li>Home</li><li>News</li></ul><p>Story {}</p>{}</body>"
    rows = [(i, "http://a.org", page.format(i, "<blockquote>rare</blockquote><table><tr><td>cell</td></tr></table>" if i == 3 else ""), "") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in html_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert got[3] == "Story 3\nrare\ncell" and got[4] == "Story 4"


def test_wrappers_decide_doubt_inside_articles(spark):
    """In an article, a doubtful box goes if its texts are the host's template and stays if they are not."""
    page = "<body><nav>x</nav>{}<h2>Summary</h2><p>Story {}</p><div class='share'>Tell friends</div><div class='notice'>Note {}</div>{}<p>out {}</p></body>"
    ways = [("<article>", "</article>"), ("<div role=main>", "</div>")]
    rows = [(10 * k + i, f"http://{k}.org", page.format(a, i, i, b, i), "") for k, (a, b) in enumerate(ways) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in html_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert len(got) == 10 and all(t == f"Summary\nStory {i % 10}\nNote {i % 10}" for i, t in got.items())


def test_licenses(spark):
    known = licenses.known_digests(spark)
    mit = "MIT  Licence\nCopyright (c) 2020 Someone\n\n" + licenses._MIT.upper().replace(",", " ;")
    docs = documents(spark, [mit, "Text.\nreleased under the MIT licence!\nMore.", *AWKWARD])
    rows = {(r["doc_id"], r["line"]): r["license_id"] for r in licenses.scan(docs, known).collect()}
    assert rows[0, None] == "MIT" and rows[1, 2] == "MIT" and rows[1, None] is None
    assert len([k for k in rows if k[1] is None]) == len(AWKWARD) + 2
    assert licenses.scan(docs.limit(0), known).count() == 0


def test_full_licences_and_passages(spark):
    """Full texts are known as documents and inside longer files, in other line breaks too."""
    known = licenses.known_digests(spark, licenses.known_texts())
    folder = pathlib.Path(licenses.__file__).parent / "license_texts"
    names = ["Apache-2.0", "BSD-3-Clause", "GPL-3.0", "CC0-1.0", "MPL-2.0", "Unlicense"]
    full = [(folder / f"{n}.txt").read_text() for n in names]
    inside = "import x\n\n" + licenses._ISC.replace(". ", ".\n\n") + " more\n"
    header = (folder / "GPL-3.0-or-later.header.txt").read_text().replace(";", "\n *")
    docs = documents(spark, [*full, *["code\n" + t + "\ncode" for t in full], inside, "/*\n * x\n *\n * " + header + " */ int a;", *AWKWARD])
    rows = {(r["doc_id"], r["line"]): r["license_id"] for r in licenses.scan(docs, known).collect()}
    assert [rows[i, None] for i in range(6)] == names and all(rows[6 + i, None] is None for i in range(6))
    assert all(n in {v for (d, line), v in rows.items() if d == 6 + i and line} for i, n in enumerate(names))
    assert rows[12, 3] == "ISC" and rows[13, 4] == "GPL-3.0-or-later"


SCHEMAS = {"find": {"required": ["q"], "properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1}}, "additionalProperties": False}}


def test_schema_errors():
    check = tool_calls.schema_error
    schema = {"type": "object", **SCHEMAS["find"]}
    assert check({"q": "a", "n": 1}, schema) is None
    assert check({}, schema) == "$.q: missing" and check({"q": 1}, schema) == "$.q: not string" and check({"q": "", "n": True}, schema) == "$.n: not integer"
    assert check({"q": "", "n": 0}, schema) == "$.n: out of range" and check({"q": "", "z": 0}, schema) == "$.z: unknown" and check([], schema) == "$: not object"


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [(1, 1, "a", None, "find", '{"q": "é", "n": 2}'), (1, 2, "b", "a", "find", '{"n": 2}'), (1, 3, "c", "b", "none", "nope"), (1, 4, "x", "y", "find", None), (1, 5, "y", "x", "find", "[1]"),
         (1, 6, "z", "x", "find", "{}"), (1, 9, "a", None, "find", "{}"), (1, 7, None, None, "find", "{}"), (2, 1, "a", "zz", "find", '{"q":"x"}')],
        "conv_id long, turn long, call_id string, after string, name string, arguments string",
    )
    results = spark.createDataFrame([(1, 2, "a", "first"), (1, 3, "a", "again"), (1, 3, "q", "lost"), (1, 3, None, "lost"), (1, 8, "b", None)], "conv_id long, turn long, call_id string, content string")
    rows = {(r["conv_id"], r["call_id"], r["kind"], r["turn"]): r for r in tool_calls.format_calls(calls, results, SCHEMAS).collect()}
    calls_of = {k[1:]: r["status"] for k, r in rows.items() if k[0] == 1 and k[2] == "call"}
    assert calls_of == {
        ("a", "call", 1): "linked", ("b", "call", 2): "linked", ("c", "call", 3): "no_result", ("x", "call", 4): "cycle", ("y", "call", 5): "cycle",
        ("z", "call", 6): "cycle", ("a", "call", 9): "duplicate", (None, "call", 7): "orphan",
    }
    assert [rows[1, i, "call", t]["level"] for i, t in (("a", 1), ("b", 2), ("c", 3))] == [0, 1, 2] and rows[2, "a", "call", 1]["level"] == 0
    assert [rows[1, i, "result", t]["status"] for i, t in (("a", 2), ("a", 3), ("q", 3), (None, 3), ("b", 8))] == ["linked", "duplicate", "orphan", "orphan", "linked"]
    first = rows[1, "a", "call", 1]
    assert first["error"] is None and first["json"] == '{"body":{"n":2,"q":"é"},"id":"a","kind":"call","name":"find"}'
    for r in rows.values():
        assert json.dumps(json.loads(r["json"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]
    assert tool_calls.format_calls(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


JSON = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats() | st.text() | st.text(st.characters(categories=["Cs"]), max_size=2),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3), max_leaves=8,
)
HARD = st.sampled_from(['{"n":1e999}', '{"n":-1e400}', '{"q":"\\ud800"}', '{"\\udfff":1}', "[" * 100_000, '{"a":' * 5000 + "1" + "}" * 5000, '{"n":' + "9" * 5000 + "}", "NaN", '{"n":Infinity}', "", "\x00", '{"q":"\\ud83d\\ude00"}'])


@settings(max_examples=300, deadline=None)
@given(text=HARD | JSON.map(lambda v: json.dumps(v)) | st.text().filter(lambda t: not re.search("[\ud800-\udfff]", t)))
def test_arguments_never_break(text):
    error, written = tool_calls.checked("find", text, SCHEMAS)
    pa.array([written], pa.string())
    value = json.loads(written)
    again = tool_calls.checked("find", written, SCHEMAS)
    assert again[1] == written or isinstance(value, str)  # canonical text is its own canonical form
    assert error is None or isinstance(error, str)


def plain_chat(calls, results):
    """Statuses and levels by following every call by hand."""
    keyed = lambda c: c[0] is not None and c[2] is not None
    rank = lambda v: tuple((x is not None, x) for x in v)
    first = {}
    for c in calls:
        if keyed(c) and (c[:1] + c[2:3] not in first or rank((c[1], c[5], c[4], c[3])) < rank((first[c[:1] + c[2:3]][1], *[first[c[:1] + c[2:3]][i] for i in (5, 4, 3)]))):
            first[c[:1] + c[2:3]] = c
    answered = {(r[0], r[2]) for r in results if r[0] is not None and r[2] is not None}

    def level(key):
        seen, n = set(), 0
        while True:
            if key in seen:
                return None
            seen.add(key)
            after = (key[0], first[key][3])
            if first[key][3] is None or after not in first:
                return n
            key, n = after, n + 1

    statuses = []
    taken = set()
    for c in calls:
        key = (c[0], c[2])
        if not keyed(c):
            statuses.append(("call", *key, None, "orphan"))
        elif c != first[key] or key in taken:
            statuses.append(("call", *key, None, "duplicate"))
        else:
            taken.add(key)
            at = level(key)
            statuses.append(("call", *key, at, "cycle" if at is None else "linked" if key in answered else "no_result"))
    best = {}
    for r in results:
        best.setdefault((r[0], r[2]), []).append(rank((r[1], r[3])))
    used = set()
    for r in results:
        key = (r[0], r[2])
        at = level(key) if key in first else None
        if key not in first:
            statuses.append(("result", *key, None, "orphan"))
        elif rank((r[1], r[3])) == min(best[key]) and key not in used:
            used.add(key)
            statuses.append(("result", *key, at, "linked"))
        else:
            statuses.append(("result", *key, at, "duplicate"))
    return statuses


def test_chats_equal_a_plain_linker(spark):
    rnd = random.Random(8)
    ids = [None, "a", "b", "c", "d", "e"]
    calls = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, *range(6)]), rnd.choice(ids), rnd.choice([*ids, None, "?"]), "find", rnd.choice([None, "{}", '{"q":"x"}'])) for _ in range(60)]
    calls += [(9, i, f"k{i}", f"k{i - 1}" if i else None, "find", "{}") for i in range(40)]  # one long chain
    results = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, 1, 2]), rnd.choice(ids), rnd.choice([None, "x", "y"])) for _ in range(40)]
    one = spark.createDataFrame([(*c, "k", 1) for c in calls], "conv_id long, turn long, call_id string, after string, name string, arguments string, row string, level int")
    two = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    more = spark.createDataFrame([(1, 0, "system", "Be brief."), (None, None, None, None)], "conv_id long, turn long, role string, content string")
    out = tool_calls.format_calls(one, two, SCHEMAS, more).collect()
    got = sorted((("%s" % r["kind"], r["conv_id"], r["call_id"], r["level"], r["status"]) for r in out if r["kind"] != "message"), key=repr)
    assert got == sorted(plain_chat(calls, results), key=repr)
    assert {r["json"] for r in out if r["kind"] == "message"} == {'{"body":"Be brief.","id":null,"kind":"message","name":"system"}', '{"body":null,"id":null,"kind":"message","name":null}'}
    for conv in (1, 2, 3, 9, None):
        own = sorted((r for r in out if r["conv_id"] == conv), key=lambda r: r["place"])
        assert [r["place"] for r in own] == list(range(len(own)))
        order = [(r["level"] is None, r["level"] or 0, r["turn"] is not None, r["turn"] or 0) for r in own]
        assert order == sorted(order)
