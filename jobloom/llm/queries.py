"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    """Vocabulary files are installed beside the library on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


SHARDS = 24


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.sharding import shard_table

    rows = shard_table(read_table(spark, folder, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return rows.withColumn("law", F.lit("key"))


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.packing import pack_documents

    return pack_documents(read_table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from jobloom.llm.byte_bpe import decode_column, encode_column

    path, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read_table(spark, folder, "documents").select("doc_id", encode_column(F.col("text"), path, pattern).alias("ids"))
    return docs.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decode_column(F.col("ids"), path, pattern), 256).alias("decoded_sha256"),
    )


@query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.secrets import KINDS, secrets_column, span_text

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    docs = read_table(spark, folder, "documents").select("doc_id", secrets_column(F.col("text")).alias("found"))
    docs = docs.select("doc_id", F.col("found.spans").alias("all"), F.filter("found.spans", lambda s: s["base"]).alias("base"), "found.layers", "found.oversize")
    return docs.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("all")).alias("spans"),
        "layers",
        "oversize",
    )


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm import quality_votes as q
    from jobloom.llm.common import stage_table

    docs = read_table(spark, folder, "documents").select("doc_id", q.signals_column(F.col("text")).alias("s"))
    s = F.col("s")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = stage_table(docs.select("doc_id", *[s[c].alias(c) for c in base], q.base_failed(s).alias("base_failed"), q.votes(s).alias("votes")), "votes")
    model = q.fit(docs)
    posterior = model.posterior_column(F.col("votes"))
    return docs.select("doc_id", *base, "base_failed", (~F.col("base_failed") & (posterior >= q.KEEP)).alias("kept"), posterior.alias("posterior"))


@query
def op8_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.topk import prepared, search

    vectors = prepared(read_table(spark, folder, "embeddings"), "vec_id", "embedding", 1024)
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0), 10)


ORACLE["op8_exact_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as a
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(range(1, len(q.a) + 1), lambda i: q.a[i] * c.a[i])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10"""


@query
def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.ngram_join import jaccard_components

    return jaccard_components(read_table(spark, folder, "documents"), width=3, percent=90)


@query
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.html_wrappers import extract

    pages = extract(read_table(spark, folder, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.licenses import known_digests, known_texts, scan

    return scan(read_table(spark, folder, "documents"), known_digests(spark, known_texts()))


def _license_oracle() -> str:
    from jobloom.llm.licenses import oracle

    return oracle()


ORACLE["op2_license_scan"] = _license_oracle()

#: Tools that the chat query derives from the turns.
TOOLS = {
    "search": {"required": ["query", "limit"], "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 20}}, "additionalProperties": False},
    "summarise": {"required": ["text"], "properties": {"text": {"type": "string"}, "words": {"type": "integer"}}},
    "translate": {"required": ["text", "to"], "properties": {"text": {"type": "string"}, "to": {"type": "string", "enum": ["en", "de", "fr", "es"]}}},
}


@query
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every user turn is a call that comes after the conversation's user turn before it; the assistant turn that follows is its
    result.  Tool and arguments follow from the turn's text; some do not fit their schema.  Turns of other roles are messages."""
    from jobloom.llm.tool_calls import format_calls

    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    call_id = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    size = F.length("text")
    arguments = (
        F.when(size % 3 == 0, F.to_json(F.struct(F.col("text").alias("query"), (size % 25).alias("limit"))))
        .when(size % 3 == 1, F.to_json(F.struct(F.col("text").alias("text"), size.alias("words"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("text"), F.element_at(F.array(*map(F.lit, ["en", "de", "fr", "es", "xx"])), (size % 5 + 1).cast("int")).alias("to"))))
    )
    name = F.element_at(F.array(*map(F.lit, TOOLS)), (size % 3 + 1).cast("int"))
    users = turns.filter(F.col("role") == "user")
    # the user turn before is two turns back; where it is not, the call counts as first
    after = F.when(F.col("turn") >= 2, F.concat(F.lit("call-"), (F.col("turn") - 2).cast("string")))
    calls = users.select("conv_id", "turn", call_id.alias("call_id"), after.alias("after"), name.alias("name"), arguments.alias("arguments"))
    results = turns.filter(F.col("role") == "assistant").select("conv_id", "turn", F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("text").alias("content"))
    others = turns.filter(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))).select("conv_id", "turn", "role", F.col("text").alias("content"))
    return format_calls(calls, results, TOOLS, others)


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.merkle import manifest

    rows = manifest(read_table(spark, folder, "documents"), MANIFEST_FIELDS)
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _manifest_oracle() -> str:
    from jobloom.llm.merkle import oracle

    return oracle(MANIFEST_FIELDS)


ORACLE["op11_merkle_manifest"] = _manifest_oracle()


@query
def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.turn_repair import repair_conversations

    return repair_conversations(read_table(spark, folder, "conversations"))


#: (host, path, verdict); a rule holds for subdomains too.
HOST_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Globs for URLs that no host rule decides: hosts that name gambling, pills, adult content, link farms or ad trackers.
BLOCK_GLOBS = ["*casino**", "*.free-bets.**", "*-bets.**", "*-pills.**", "*.spam-**", "*.adult-**", "*.porn**", "*.ads-**", "*.ads.**", "*.adserver.**", "*.tracking.**"]
#: Robots and policy files stay readable on every host.
ALLOW_GLOBS = ["*/robots.txt", "*/.well-known/**"]


@query
def op13_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    from jobloom.llm.url_rules import HostRule, judge

    pages = read_table(spark, folder, "pages").select("page_id", "url")
    rows = judge(pages, [HostRule(*r) for r in HOST_RULES], ALLOW_GLOBS, BLOCK_GLOBS)
    return rows.select("page_id", "host", "path", "rule", "verdict")


def _url_oracle() -> str:
    from jobloom.llm.url_rules import HostRule, oracle

    return oracle([HostRule(*r) for r in HOST_RULES], ALLOW_GLOBS, BLOCK_GLOBS)


ORACLE["op13_url_filters"] = _url_oracle()
