"""The operators of this package, bound to the test tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import chat, decontamination, fill_middle, fingerprints, importance, line_dedup, near_dedup, packing, pii, sharding, substring_dedup, toxicity, url_filter
from .common import table

SHARDS = 24
URL_RULES = [  # fixed values
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_dropped", "text")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return toxicity.learn(table(spark, sf_dir, "documents"), labels)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every whole text, by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    predicted = (F.col("toxic_score") >= 0.5).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), predicted.alias("predicted"), "toxic_passages")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item that occurs in a document, with its distance and place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot under law rows."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    dealt = sharding.shard(keys, "doc_id", SHARDS, ties=["text_crc32", "size"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    return fingerprints.with_edited(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under links of three quarters."""
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, "url", URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's spans of personal data: those of the patterns and those that the tagger adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.learn(docs))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda x: (x["kind"] == kind) & ~x["added"])).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda x: ~x["added"])
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans")
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 35 words that start anywhere else."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    return substring_dedup.dedup(docs).select("doc_id", "n_words", "n_removed", kept)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards benchmark's distribution, and the rank of those drawn."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two lines and put in another order, with the text rebuilt from that."""
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    again = fill_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(c.cast("binary"), 256).alias(f"{x}_sha256") for c, x in ((F.col("output"), "output"), (again, "restored"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says control strings, formatted; the digests are read back from the output."""
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    made = chat.conversations(rows.withColumn("content", chat.text_part(F.col("text"))), "conv_id", "turn", "role", "content")

    def told(t: Column) -> Column:
        return F.transform(F.array(chat.read_turn(t["formatted"])), lambda x: F.concat(x["role"], F.lit("\n"), F.array_join(x["parts"]["text"], ""), F.lit("\n")))

    learnt = F.array_join(F.transform("turns", lambda t: chat.learnt_text(t["formatted"], t["loss"])), "")
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.length(t["formatted"]))
    tokens = F.aggregate(F.flatten("turns.attachments"), F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    read = made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.flatten(F.transform("turns", told)), "").cast("binary"), 256).alias("turns_sha256"),
        learnt.alias("learnt"),
        chars.alias("formatted_chars"),
        tokens.alias("attachment_tokens"),
    )
    loss = [F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256")]
    return read.select("conv_id", "n_turns", "turns_sha256", *loss, "formatted_chars", "attachment_tokens")


OP8_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM parts
), rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'),
         ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), best AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM split s LEFT JOIN best b USING (page_id)
"""

#: The CRC table is made by its rule, a step for each bit of each byte; features are spelled out and told apart as texts.
OP11_SQL = r"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT range::UBIGINT, 0, range::UBIGINT FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8
), texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), parted AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
), features AS (
  SELECT side, id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS f FROM parted
), spelled AS (
  SELECT f, list_transform(range(1, octet_length(encode(f)) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::UBIGINT) AS bytes FROM (SELECT DISTINCT f FROM features)
), dealt AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT % 10000 AS bucket FROM spelled, crc
), totals AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM features JOIN dealt USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM totals
), sums AS (
  SELECT id AS doc_id, count(*) AS n, sum(gain) AS g FROM features JOIN dealt USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), weighed AS (
  SELECT p.id AS doc_id, len(words) AS w, coalesce(n, 0) AS n_features, coalesce(floor(g::DOUBLE / n)::BIGINT, 0) AS weight FROM parted p LEFT JOIN sums ON p.id = doc_id WHERE side = 'd'
), scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::UBIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score FROM weighed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY w >= 20 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY w >= 20) AS n_able FROM scored
)
SELECT doc_id, n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN w >= 20 AND r <= 25 * n_able // 100 THEN r END AS rank FROM placed
"""

OP12_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('7:' || doc_id) AS h FROM documents
), drawn AS (
  SELECT *, len(units) AS n, list_transform([0, 1, 2, 3], lambda k: ('0x' || substr(h, 8 * k + 1, 8))::UBIGINT::BIGINT) AS x FROM base
), cut AS (
  SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 100 THEN 'plain' WHEN x[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m, coalesce(array_to_string(units[b + 1:], ''), '') AS s FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

OP13_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), made AS (
  SELECT *, '<|turn|>' || regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') || '<|text|>' || regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') || '<|end|>' AS formatted FROM said
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(formatted))::BIGINT AS formatted_chars, 0::BIGINT AS attachment_tokens
FROM made GROUP BY conv_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_fingerprints": op5_fingerprints,
    "op6_packing": op6_packing,
    "op7_near_dedup": op7_near_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_pii": op9_pii,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_importance": op11_importance,
    "op12_fill_middle": op12_fill_middle,
    "op13_chat": op13_chat,
}
ORACLES: dict[str, str] = {"op8_url_filter": OP8_SQL, "op11_importance": OP11_SQL, "op12_fill_middle": OP12_SQL, "op13_chat": OP13_SQL}
