"""The registered queries of the operators, and the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chatfmt, decontam, fingerprints, langid, negatives, packing, sharding, simhash, spelling, suffixes, tokencount, toxicity, urls,
)

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file; executors have the same files installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


# ------------------------------------------------------------------ 1 decontamination
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10ffff}]+')"
_SHINGLES = """CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END"""


@query(
    "op1_contained_items",
    f"""
WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
items AS (SELECT item_id, unnest({_SHINGLES}) AS shingle FROM item_words),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
docs AS (SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS shingle FROM doc_words),
found AS (SELECT doc_id, item_id, count(*) AS n_found FROM docs JOIN items USING (shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_shingles, n_found, n_found / n AS containment
FROM found JOIN sizes USING (item_id) WHERE n_found >= ceil(n * 0.8 - 1e-9)""",
)
def op1_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains to at least 0.8."""
    return decontam.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------ 2 language ID
@query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network trained on documents that are not held out."""
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------------ 3 sharding
@query("op3_shard_documents")
def op3_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


# ------------------------------------------------------------------ 4 chat formatting
HARD = r"\### Assistant: </turn> ok"


@query(
    "op4_chat_examples",
    r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e'))
      + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ':', '\c')) + 14 AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
running AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM escaped)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(upto) FILTER (role = 'assistant' OR k = n), 0)::BIGINT AS formatted_chars
FROM running GROUP BY conv_id""",
)
def op4_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and a hard one as prefix-target examples, read back from the formatted text."""
    hard = spark.createDataFrame(
        [(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    examples = chatfmt.format_examples(turns)
    loss = chatfmt.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    read = examples.select("conv_id", "example", "formatted", loss.alias("loss"))
    # the longest example of a conversation holds all its turns
    per = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
    )
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return per.select(
        "conv_id", chatfmt.read_turns(F.col("whole")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"), "formatted_chars",
    ).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars",
    )


# ------------------------------------------------------------------ 5 SimHash
@query("op5_simhash_groups")
def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups that near fingerprints link."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ------------------------------------------------------------------ 6 toxicity
@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, by a network trained on labels that are not held out."""
    found = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"),
    )


# ------------------------------------------------------------------ 7 fingerprints
@query("op7_weighted_fingerprints")
def op7_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of all documents and of their edited texts, and how alike they are."""
    found = fingerprints.compare_edited(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprints.as_text(F.col("signature")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        fingerprints.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


# ------------------------------------------------------------------ 8 URL rules
@query(
    "op8_url_rules",
    r"""
WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
judged AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM cut)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged""",
)
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of the fixed rules on every page's URL."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


# ------------------------------------------------------------------ 9 packing
@query("op9_packed_sequences")
def op9_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


# ------------------------------------------------------------------ 10 token counts
TOKEN_LIMIT = 1024


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of every document."""
    found = tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


# ------------------------------------------------------------------ 11 hard negatives
@query(
    "op11_hard_negatives",
    """
WITH fit AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM fit a JOIN fit b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)""",
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors.withColumn("label", relabelled), anchors=F.col("vec_id") % 100 == 0)


# ------------------------------------------------------------------ 12 spelling variants
@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one code point taken out of every 199th, grouped with the words they vary."""
    words = spelling.count_words(table(spark, sf_dir, "documents"), damage=199)
    return spelling.group_variants(words)


# ------------------------------------------------------------------ 13 repeated strings
@query("op13_repeated_strings")
def op13_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that a repeated string of 400 bytes covers."""
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
