"""Registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from nestloom.llm import (
    chat,
    content_sort as sorting,
    language,
    lexical,
    mixing,
    ngram_join,
    oracles,
    packing,
    page_text,
    quality_trees,
    suffix_dedup,
    toxicity,
    turn_repair,
    weighted_sampling,
)
from nestloom.llm.common import documents, fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = fold(F.col("doc_id"), 5) == 0
    learned = language.fit_dictionaries(docs.where(~held & F.col("lang").isNotNull()))
    return language.classify(docs, learned).select("doc_id", held.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorting.content_sort(documents(spark, sf_dir), keep="largest")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = documents(spark, sf_dir), fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.examples(turns.unionByName(extra)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = documents(spark, sf_dir), fold(F.col("doc_id"), 3) == 1
    model = quality_trees.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return quality_trees.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(documents(spark, sf_dir))


MIX_SHARES = {  # what the mixture is wanted to hold; sources are wanted alike
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15},
    "topic": {"prose": 0.6, "legal": 0.1, "contact": 0.1, "markup": 0.2},
}
MIX_KEEP, MIX_ROUNDS, MIX_SEED = 0.5, 6, 17


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    targets = {m: spark.createDataFrame([*shares.items()], f"_{m} string, target double") for m, shares in MIX_SHARES.items()}
    targets["source"] = docs.select(F.coalesce("source", F.lit("")).alias("_source")).distinct().withColumn("target", F.lit(1.0))
    mixed = mixing.mix(docs, targets, seed=MIX_SEED, keep=MIX_KEEP, rounds=MIX_ROUNDS, close=None)
    return mixed.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"), F.round("mix_probability", 6).alias("probability"), F.col("mix_kept").alias("kept"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("spans")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(documents(spark, sf_dir)))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=50)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turn_repair.digests(turn_repair.repair(turn_repair.damage(turns)), turns)


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return page_text.extract(pages, page_text.fit(pages))


_QUERIES = (
    op1_ngram_jaccard_join,
    op2_language_id,
    op3_exact_dedup,
    op4_toxicity,
    op5_chat_formatting,
    op6_quality,
    op7_fingerprints,
    op8_mixing,
    op9_suffix_dedup,
    op10_best_fit_packing,
    op11_ranked_search,
    op12_turn_repair,
    op13_page_text,
)
REGISTRY: dict[str, Query] = {f.__name__: f for f in _QUERIES}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": rf"""
        WITH RECURSIVE w AS MATERIALIZED (
          SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS MATERIALIZED (
          SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
            ELSE list_sort(list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)])) END AS sh FROM w),
        reps AS MATERIALIZED (SELECT min(doc_id) AS rep, sh, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
        u AS MATERIALIZED (SELECT rep, n, unnest(sh) AS g FROM reps),
        pairs AS MATERIALIZED (
          SELECT a.rep AS a, b.rep AS b FROM u a JOIN u b ON a.g = b.g AND a.rep <> b.rep
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (SELECT rep AS a, rep AS b FROM reps UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
        roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
        SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, CAST(coalesce(root, s.doc_id) AS BIGINT) AS component_id
        FROM s LEFT JOIN reps ON reps.sh = s.sh LEFT JOIN roots ON roots.a = reps.rep""",
    "op5_chat_formatting": r"""
        WITH t AS (
          SELECT conv_id, turn, role, coalesce(text, '') AS x FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        f AS (
          SELECT *, sum(length('### ' || regexp_replace(role, '([\\#<:])', '\\\1', 'g') || ': '
              || regexp_replace(x, '([\\#<])', '\\\1', 'g') || '</turn>') + 1) OVER w AS upto,
            role = 'assistant' AS reply, lead(turn) OVER w IS NULL AS ends
          FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, x))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY turn, role, x)) AS turns_sha256,
          CAST(coalesce(sum(length(x)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(x, '' ORDER BY turn, role, x) FILTER (reply), '')) AS loss_sha256,
          CAST(sum(upto) FILTER (reply OR ends) AS BIGINT) AS formatted_chars, count(*) FILTER (reply OR ends) AS examples
        FROM f GROUP BY conv_id""",
    "op3_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY norm)""",
    "op8_mixing": oracles.mixing_sql(MIX_SHARES, MIX_KEEP, MIX_ROUNDS, MIX_SEED),
    "op11_ranked_search": oracles.RANKED_SEARCH,
    "op12_turn_repair": oracles.TURN_REPAIR,
    "op13_page_text": oracles.PAGE_TEXT,
}
