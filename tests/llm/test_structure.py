"""Merkle manifest, conversation repair and URL rules against plain Python."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobloom.llm import merkle, turn_repair, url_rules
from jobloom.llm.queries import ALLOW_GLOBS, BLOCK_GLOBS, HOST_RULES, MANIFEST_FIELDS

RULES = [url_rules.HostRule(*r) for r in HOST_RULES]


# Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, changed=False):
    text = row["text"]
    if changed and text is not None:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(digests):
    """(root, per leaf a list of (left, right) up to the root)."""
    paths, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            first = i // 16 * 16
            paths[leaf].append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 16])))
        nodes = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], paths


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[name] = plain_tree([leaf_of(r) for r in groups[name]])
    root, above = plain_tree([trees[name][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            path = trees[name][1][i] + above[place]
            folded = leaf_of(row, tampered)
            for left, right in path:
                folded = h(left + folded + right)
            out.append((row["doc_id"], leaf_of(row), trees[name][0], root, h("".join(a + b for a, b in path)), folded, folded == root))
    return out


TABLE = "doc_id long, source string, lang string, n_chars long, text string, digest string, rank long, g int"


def manifest_rows(spark, rows):
    table = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], TABLE).repartition(5)
    got = merkle.manifest(table, MANIFEST_FIELDS).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    plain = plain_manifest([dict(zip(["doc_id", "source", "lang", "n_chars", "text"], r)) for r in rows])
    return sorted(map(tuple, got), key=repr), sorted(plain, key=repr)


def test_manifest_equals_a_plain_tree(spark):
    rows = [(i * 3, "hot", "en", i, f"Text {i}") for i in range(700)]  # three blocks: a whole subtree, another, and a part
    rows += [(i, "exact", None, None, "A" * i) for i in range(256)] + [(i, "one more", "de", 5, "Ü") for i in range(257)]
    rows += [(1, "lone", "en", 0, ""), (2, None, "en", 1, None), (None, None, None, None, None), (None, "", "", 0, "X" * 100_000)]
    rows += [(9, "same", "en", 2, "Twice")] * 20 + [(9, "same", "en", 2, "other")]
    got, plain = manifest_rows(spark, rows)
    assert got == plain
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_many_groups(spark):
    got, plain = manifest_rows(spark, [(i, f"s{i:04}", "en", i, "a") for i in range(300)] + [(7, "s0001", "en", 1, "B")])
    assert got == plain


@pytest.mark.parametrize("rows", [[], [(5, "only", "en", 1, "Ab")], [(5, None, "en", 1, "Ab"), (6, None, "en", 1, "Ab")]])
def test_manifest_of_small_tables(spark, rows):
    got, plain = manifest_rows(spark, rows) if rows else (merkle.manifest(spark.createDataFrame([], TABLE), MANIFEST_FIELDS).collect(), [])
    assert got == plain


# Conversation repair


def every_repair(turns, inserts=2):
    """Lightest (cost, audit) over all edits with at most ``inserts`` inserted turns in a gap: no agenda, no states."""
    best = None
    gaps = [""] + ["I" * i for i in range(1, inserts + 1)]
    choices = ["D" if t == "x" else "DKR" for t in turns]
    for edits in itertools.product(*choices):
        for between in itertools.product(gaps, repeat=len(turns) + 1):
            audit = "".join(g + e for g, e in zip(between, [*edits, ""]))
            kept = [(e, t) for e, t in zip(edits, turns) if e != "D"]
            cost = sum({"D": 2, "K": 0, "R": 1}[e] for e in edits) + 5 * audit.count("I") + 5 * sum(t.isupper() for _, t in kept)
            if best is not None and (cost, audit) >= best:
                continue
            order, rest = audit.replace("D", ""), iter(kept)
            want = None  # roles are fixed by their places: s only as a kept first turn, then u and a in turn
            given = []
            for e in order:
                turn = next(rest)[1] if e != "I" else None
                given.append((e, turn))
            system = bool(given) and given[0][0] == "K" and given[0][1].lower() == "s"
            body = given[1:] if system else given
            want = "ua" * (len(body) // 2)
            fits = len(body) % 2 == 0 and (not system or body) and all(e != "K" or t.lower() == w for (e, t), w in zip(body, want))
            if fits:
                best = (cost, audit)
    return best


@settings(max_examples=120, deadline=None)
@given(turns=st.text("suaoxSUA", max_size=4))
def test_repair_equals_every_repair(turns):
    assert turn_repair.repair(turns) == every_repair(turns)


@settings(max_examples=150, deadline=None)
@given(turns=st.text("suaoxUAS", max_size=60), size=st.integers(1, 7))
def test_runs_append_to_the_same_repair(turns, size):
    cut = [turns[i : i + size] for i in range(0, len(turns), size)] or [""]
    assert turn_repair.append_runs(turn_repair.run_repairs(c, i == 0) for i, c in enumerate(cut)) == turn_repair.repair(turns)


def plain_conversation(rows):
    """The contract for one conversation's rows (conv_id, turn, role, text), with the lightest repair from ``repair``."""
    left = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        left += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
    counts, codes, seen, initials = dict(blank=0, duplicate=0, truncated=0), "", set(), []
    for _, role, text in left:
        initial = role[0] if role[:1] in ("s", "u", "a") else "o"
        initials.append(initial)
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
        if fault:
            counts[fault] += 1
        seen.add((role, text))
        codes += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    cost, audit = turn_repair.repair(codes)
    lines, rest, state = [], iter(left), 0
    for e in audit:
        if e == "D":
            next(rest)
            continue
        given = "a" if state == turn_repair.USER else "u"
        role, text = ({"u": "user", "a": "assistant"}[given], "") if e == "I" else next(rest)[1:]
        if e == "K":
            given = role[0]
        elif e == "R":
            role = {"u": "user", "a": "assistant"}[given]
        lines.append(f"{role}:{text}")
        state = turn_repair.NEXT[given][state]
    turns = {t for t, _, _ in left if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (rows[0][0], gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def check_conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string, seq long, digest string, ways string"
    table = spark.createDataFrame([(*r, 1, "d", "w") for r in rows], schema).repartition(3)
    got = sorted(map(tuple, turn_repair.repair_conversations(table).collect()), key=repr)
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    assert got == sorted((plain_conversation(g) for g in groups.values()), key=repr)
    return got


def test_conversations_equal_plain_code(spark):
    rows = []
    for conv in [*range(120), None]:
        for turn in range(1 + (conv or 3) % 7):
            role = ["user", "assistant", "system", "tool", None, "user"][(turn * 7 + (conv or 0)) % 6]
            text = ["Yes. ", "No", "  \n", None, "Why?\x0b", "Ünd…", "Yes. "][(turn * 3 + (conv or 0)) % 7]
            rows.append((conv, None if turn == 4 else turn * (1 + (conv or 0) % 3), role, text))
    rows += [rows[5]] * 3 + [(500, 1, "user", "x" * 200_000 + "."), (501, None, "", "")]
    got = check_conversations(spark, rows)
    assert {r[0] for r in got} >= {None, 500, 501}


def test_a_long_conversation_is_cut_into_runs(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "RUN", 16)
    rows = [(1, t, ["user", "assistant", "user", "system", "assistant"][t * t % 5], f"Line {t % 90}{'.' if t % 11 else ''}") for t in range(400)]
    rows += [(1, 7, "user", "Same."), (1, 7, "user", "Same."), (2, 0, "system", "Be brief."), (2, 1, "user", "Hi!")]
    got = check_conversations(spark, rows)
    assert len(got[0][7]) >= 350


def test_conversations_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repair_conversations(empty).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    check_conversations(spark, [(3, dropped, "user", "Gone.")])


# URL rules


def glob_pattern(text):
    out, i = "", 0
    while i < len(text):
        if text[i] == "*":
            n = len(text) - i - len(text[i:].lstrip("*"))
            out, i = out + (".*" if n > 1 else "[^/]*"), i + n
        elif text[i] == "[":
            end = text.index("]", i + 1)
            out, i = out + "[" + text[i + 1 : end].replace("!", "^", 1) + "]", end + 1
        else:
            out, i = out + ("[^/]" if text[i] == "?" else re.escape(text[i])), i + 1
    return re.compile(out, re.S)


GLOBS = st.lists(st.sampled_from(["a", "b", "/", ".", "é", "*", "**", "?", "[ab]", "[!a]", "[a-c]"]), max_size=6).map("".join)


@settings(max_examples=300, deadline=None)
@given(globs=st.lists(GLOBS, min_size=1, max_size=40), texts=st.lists(st.text("ab/.éc\n", max_size=9), max_size=6))
def test_automaton_equals_regular_expressions(globs, texts):
    found = url_rules.Automaton([url_rules.parse_glob(g) for g in globs]).hits(texts).to_pylist()
    assert found == [[i for i, g in enumerate(globs) if glob_pattern(g).fullmatch(t)] for t in texts]


def test_globs_longer_than_a_word_and_small_blocks(monkeypatch):
    monkeypatch.setattr(url_rules, "STATE_BYTES", 64)
    globs = ["*" + "ab" * 70 + "**", "a" * 63, "a" * 64, "a" * 65, "**" + "b" * 128]
    texts = ["ab" * n for n in (69, 70, 71, 2000)] + ["a" * n for n in (62, 63, 64, 65)] + ["b" * 128, "", "/" + "ab" * 70]
    found = url_rules.Automaton([url_rules.parse_glob(g) for g in globs]).hits(texts).to_pylist()
    assert found == [[i for i, g in enumerate(globs) if glob_pattern(g).fullmatch(t)] for t in texts]


@pytest.mark.parametrize("bad", ["[ab", "a\\", "[]"])
def test_bad_globs(bad):
    with pytest.raises(ValueError):
        url_rules.parse_glob(bad)


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        rule = max(fits, key=lambda r: len(r.text))
        return host, path, rule.text, rule.verdict
    hit = lambda globs: any(glob_pattern(g).fullmatch(f".{host}{path}") for g in globs)
    return host, path, None, "allow" if hit(ALLOW_GLOBS) or not hit(BLOCK_GLOBS) else "block"


def test_urls_equal_plain_code(spark):
    urls = [None, "", "://", "no scheme", "https://COM", "https://Example.COM/en/a?x#y", "http://www.example.com/en/", "http://awww.example.com/en/", "http://example.com.evil.org/en/"]
    urls += ["ftp://x.net/es/?q", "ftp://x.net/es", "http://net/fr/é", "http://x.org/a.com/b", "http://x.org?http://a.com/", "a://b://c.com/", "http://u@x.com:80/", "http://casino.org", "http://casino.org/robots.txt"]
    urls += ["http://a.free-bets.org/x", "http://a.org/casino/", "http://.net/es/", "http://x.com\n/a", "http://İ.COM/", "https://x.org/" + "a" * 50_000, "HTTP://WWW.EXAMPLE.COM/EN/"] * 2
    table = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string").repartition(3)
    rows = url_rules.judge(table, RULES, ALLOW_GLOBS, BLOCK_GLOBS).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows] == [plain_verdict(u) for u in urls]
    assert url_rules.judge(table.limit(0), RULES).count() == 0
