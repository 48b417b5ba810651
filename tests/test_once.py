"""Expensive steps run once: what the plans hold, and that the results stay."""

import pytest
from pyspark.sql import functions as F

from jobloom import fixed_values as fx
from jobloom.functions.positions import phrase_positions
from jobloom.operators import classify, search
from jobloom.schema import HISTORY
from jobloom.sources import cards


def plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().treeString()


def test_served_orders_make_their_keys_once(spark):
    """several orders of one set of rows are what each gives alone."""
    rows = spark.createDataFrame([("a", "Dev 10", "x", 1, 5), ("b", "dev 9", "X", 2, 5), ("c", None, "", 2, 7), ("d", "Dév 9", "é", 1, 5)], "job_uid string, title string, company string, portals int, activity long")
    sorts = ("recent", "company", "title", "portals")
    together = {tuple(r) for r in search.served_orders(rows, sorts).collect()}
    assert together == {(s, *r) for s in sorts for r in search.numbered(rows, s).collect()}


def test_cards_search_long_lines_once(spark):
    """the place of a card is settled in one pass over its lines."""
    rows = spark.createDataFrame([("https://x.example/vaga__1.aspx", "Nova", "Dev\nHoje\nRecife - PE\nFirma\n" + "y" * 200)], "href string, title string, text string")
    found = cards.normalize_cards(rows, F.lit("2024-04-30"))
    assert plan(found).count("todo brasil") <= 4
    got = found.first()
    assert (got["title"], got["city"], got["state"], got["company"]) == ("Dev", "Recife", "PE", "Firma")


def test_card_portals_build_their_own_pages(spark, tmp_path):
    """no portal builds the pages of the others."""
    from jobloom.plans import load_queries

    spark.createDataFrame([(7, "blue rod")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    found = load_queries()[0]["src_02_card_portals"](spark, str(tmp_path))
    assert plan(found).count("index__job-opportunities__grid__item\" data-title") <= 8
    assert found.count() == 11


def test_alerts_fold_and_search_a_text_once(spark):
    """the patterns of three modalities stand in the plan once per text, not once per use; a head of a long text stands for the whole."""
    long = "é" * 11_900 + " modalidade: remoto " + "x" * 30_000
    rows = spark.createDataFrame([(0, "modelo de trabalho: presencial"), (1, long), (2, None), (3, "\n" * 30_000 + "modalidade: remoto"), (4, "́" * 30_000 + "modalidade: remoto")], "i int, t string")
    alerts = rows.select("i", classify.contradiction_alerts(F.col("t"), F.lit("Brasil"), F.col("t"), F.lit("Híbrido"), F.lit(True)).alias("a"))
    assert plan(alerts).count(",55}") <= 2 * len(fx.MODALITY_IN_TEXT)
    stated = {r["i"]: r["m"] for r in rows.select("i", classify.stated_modality(F.col("t")).alias("m")).collect()}
    assert stated == {0: "Presencial", 1: "Remoto", 2: "", 3: "Remoto", 4: "Remoto"}
    assert {r["i"]: len(r["a"]) for r in alerts.collect()} == {0: 2, 1: 2, 2: 0, 3: 1, 4: 2}


def test_positions_are_plain_numbers(spark):
    """F7, F8: a batch of hits is lists of numbers, not an object per hit; nulls, empty texts and texts without hits stay."""
    rows = spark.createDataFrame([(0, "sql of sql, the go"), (1, None), (2, ""), (3, "nothing"), (4, "the the sql")], "i int, t string").coalesce(1)
    found = rows.select("i", phrase_positions(F.col("t"), ["sql", "go"], [True, True], [["of"], ["the", "e "]], 8).alias("h"))
    assert "find(t#" in plan(found) and "204" not in plan(found).split("find(t#")[1].split("\n")[0]
    got = {r["i"]: r["h"] and [(h["phrase"], h["start"], h["end"], list(h["before"])) for h in r["h"]] for r in found.collect()}
    assert got == {0: [(0, 0, 3, [-1, -1]), (0, 7, 10, [4, -1]), (1, 16, 18, [-1, 14])], 1: None, 2: [], 3: [], 4: [(0, 8, 11, [-1, 6])]}
    bare = rows.select(phrase_positions(F.col("t"), ["go"], [True]).alias("h"))
    assert [r["h"] and [tuple(h) for h in r["h"]] for r in bare.collect()] == [[(0, 16, 18, [])], None, [], [], []]
    assert [r["h"] for r in rows.select(phrase_positions(F.col("t"), []).alias("h")).collect()] == [[], None, [], [], []]


@pytest.mark.parametrize("text", ["", "two words"])
def test_decoding_makes_no_automaton(text):
    """op10: only workers that encode hold the automaton."""
    pytest.importorskip("public_tokenizers")
    import public_tokenizers

    from jobloom.llm import byte_bpe
    from jobloom.llm.queries import tokenizer_path

    byte_bpe.load.cache_clear()
    codec = byte_bpe.load(tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert codec.decode(b"") == b"" and "automaton" not in vars(codec)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_snapshot_rows_stay_off_the_driver(spark):
    """no join of the snapshot broadcasts keys or rows that hold whole texts."""
    from jobloom.operators import snapshot as sn
    from jobloom.session import materialize

    fields = {"first_seen_date": "2024-04-01", "last_seen_date": "2024-04-30", "published_date": "2024-04-20", "market": "BR"}
    names = [f.name for f in HISTORY.fields]
    kinds = {f.name: f.dataType for f in HISTORY.fields}
    rows = spark.range(6).select(
        *[
            (F.concat(F.lit("u"), "id") if n == "job_uid" else F.concat(F.lit("s"), (F.col("id") % 2)) if n == "source"
             else F.when(F.col("id") < 3, "same").otherwise(F.concat(F.lit("k"), "id")) if n == "dedupe_key" else F.lit(fields.get(n))).cast(kinds[n]).alias(n)
            for n in names
        ]
    )
    shot = sn.build(materialize(rows), F.lit("2024-04-30").cast("date"), keep=materialize)
    assert sorted(r["np"] for r in shot.rows.collect()) == [1, 1, 1, 2, 2, 2]
    for frame, joins in ((shot.rows, 0), (shot.encoded(), 1)):  # the dictionaries are small
        assert frame._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") <= joins
    assert shot.encoded().count() == 6
