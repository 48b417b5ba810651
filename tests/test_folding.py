"""Folds against unicodedata, over every code point and over mixed texts."""

import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from jobloom.functions import folding, text as tx

def bare(text):
    return "".join(ch for ch in text if not unicodedata.combining(ch))


def ascii_fold(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()


def caseless_fold(text):
    return re.sub(r"\s", " ", bare(unicodedata.normalize("NFKD", text.casefold())).replace("–", "-").replace("—", "-"))


def search_fold(text):
    return "".join(ch for ch in unicodedata.normalize("NFD", text) if not "̀" <= ch <= "ͯ").lower()


@pytest.fixture(scope="module")
def every(spark):
    """Each code point between two letters, so that white space stays visible."""
    codes = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    rows = spark.createDataFrame([(c, f"x{chr(c)}y") for c in codes], "c int, t string").repartition(8)
    out = rows.select("c", "t", tx.fold_ascii("t").alias("a"), tx.fold_caseless("t").alias("n"), tx.fold_search("t").alias("s"))
    return out.collect()


def test_ascii_fold_of_every_code_point(every):
    assert [r["c"] for r in every if r["a"] != ascii_fold(r["t"])] == []


def known(row):
    """Lower case comes from the JVM, which may know letters that Python's tables do not have yet."""
    return unicodedata.category(chr(row["c"])) != "Cn"


def test_caseless_fold_of_every_code_point(every):
    assert [r["c"] for r in every if r["n"] != caseless_fold(r["t"]) and known(r)] == []


def test_search_fold_of_every_code_point(every):
    assert [r["c"] for r in every if r["s"] != search_fold(r["t"]) and known(r)] == []


def test_folds_of_texts_inside_lambdas(one):
    texts = ["ΓαΣ 𝚪Γ ½ ﬁne… №5 ㎡", "한국어 각 가", "Ação — Ünïcödé ß ẞ İ", "日本語 ｶﾞ Ⅷ", "", "plain", "𝐀𝐀 À̖́"]
    for t in texts:
        values = one(*[F.transform(F.array(F.lit(t)), f)[0] for f in (tx.fold_ascii, tx.fold_caseless, tx.fold_search)])
        squeezed = " ".join(caseless_fold(t).split(" ")).strip()
        assert values == (ascii_fold(t), re.sub(" +", " ", squeezed), search_fold(t).strip()), t
        assert one(tx.fold_caseless(F.lit(t))) == tx.py_fold_caseless(t)


def test_squeeze_and_strip(one):
    for t in ["", " ", "a  b", "\u3000a \xa0 b\ufeff", "é\t\x1fé ", "\x85ü  ü\u2028", "a\nb", "日 本"]:
        plain = re.sub(tx.WS.replace("\\s", r" \t-\r"), " ", t)
        assert one(tx.squeeze(F.lit(t)), tx.strip(F.lit(t))) == (" ".join(x for x in plain.split(" ") if x), t.strip(tx._BLANKS)), repr(t)


def test_a_fold_must_not_feed_itself():
    with pytest.raises(ValueError):
        folding._pages(lambda ch: {"á": "é", "é": "e"}.get(ch, ch), False)
