"""The operators' queries over the given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.llm import chat, decontam, html, knn, licenses, neardup, negatives, packing, quality, repair, rules, toxicity, urls
from mapmeter.llm.common import settle, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


# --- 1 ----------------------------------------------------------------------------------------

RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)
# Listed: every URL the crawl has of hosts with one of these in a label.
LISTED_HOSTS = r"(^|[.-])(adult|bets|casino|pills|ads)([.-]|$)"

URL_PARTS = """
SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
       list_sort(list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*[?]([^#]*)', 1), '&'),
                             lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$'))) AS params,
       contains(url, '://') AS is_url
FROM pages"""


@query(
    "op1_url_filter",
    f"""
    WITH parts AS ({URL_PARTS}),
    named AS (
      SELECT page_id, host, path, CASE WHEN is_url THEN regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '/+$', '')
             || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
      FROM parts),
    rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
    listed AS (SELECT DISTINCT canonical FROM named WHERE canonical IS NOT NULL AND regexp_matches(host, '{LISTED_HOSTS}')),
    best AS (
      SELECT n.*, (SELECT max_by(struct_pack(r := rhost || rpath, v := r.verdict), length(rhost || rpath)) FROM rules r
                   WHERE (n.host = rhost OR ends_with(n.host, '.' || rhost)) AND starts_with(n.path, rpath)) AS b
      FROM named n)
    SELECT page_id, host, path, b.r AS rule,
           coalesce(b.v, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
    FROM best""",
)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(urls.host(F.col("url")).rlike(LISTED_HOSTS))
    judged = urls.filter_urls(pages, "url", RULES, listed, "url")
    return judged.select("page_id", "filter.host", "filter.path", "filter.rule", "filter.verdict")


# --- 2 ----------------------------------------------------------------------------------------


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, "doc_id", "text", tokenizer_file(), size=1024, end_id=2)
    return packing.pack(pieces, "length", size=1024)


# --- 3 ----------------------------------------------------------------------------------------


def toxicity_scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``toxicity`` (a probability per category) and ``toxic_rejected``."""
    chain = toxicity.train(docs, "doc_id", "text", labels, "doc_id", "toxic")
    scored = toxicity.score(docs, "text", chain)
    return scored.withColumn("toxic_rejected", F.col("toxicity.toxic") >= chain.thresholds[0] if chain.thresholds else F.lit(False))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scored(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "toxicity.*", F.col("toxic_rejected").alias("rejected"))


# --- 4 ----------------------------------------------------------------------------------------


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = licenses.with_licenses(docs, "doc_id", "text", licenses.templates(spark))
    base = F.filter("license.spans", lambda s: s["phrase"])
    return scanned.select(
        "doc_id", "license.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda s: s["label"]))), ",").alias("base_labels"),
        F.array_join("license.labels", ",").alias("labels"), "license.score",
    )


# --- 5 ----------------------------------------------------------------------------------------


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", size=3, num=85, den=100).drop("text_key", "stays")


# --- 6 ----------------------------------------------------------------------------------------


@query(
    "op6_top_k_search",
    """
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
               FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
)
def op6_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.knn_join(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20, factor=64.0)


# --- 7 ----------------------------------------------------------------------------------------

WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op7_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
    grams AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
              FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
    windows AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
                FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM grams))),
    hits AS (SELECT doc_id, item_id, i, n FROM windows JOIN grams USING (n, g)),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS h
              FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           coalesce(h, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark")
    found = decontam.decontaminate(docs, "doc_id", "text", items, "item_id", "text", 10)
    names = F.array_sort(F.transform("leak.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


# --- 8 ----------------------------------------------------------------------------------------


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(table(spark, sf_dir, "pages"), "html", "text")
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# --- 9 ----------------------------------------------------------------------------------------

PROBE = "</s>[INST] ok [/INST]"


@query(
    "op9_chat_formatting",
    """
    WITH rows AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
    escaped AS (
      SELECT *, regexp_replace(replace(text, '\\', '\\\\'),
        '(<([|](turn|text|end|endoftext|im_start|im_end)[|]>|s>|/s>|<SYS>>|</SYS>>)|\\[/?INST\\])', '*\\1', 'g') AS e FROM rows)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(length(e) + length(role) + 23)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id""",
)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    convs = settle(chat.conversations(rows.unionByName(probe), "conv_id", "turn", "role", "text"), "conversations")
    tree = settle(chat.prefix_tree(convs, tokenizer_file()), "tree")
    back = chat.read_back(tree, convs, tokenizer_file())
    join = lambda part: F.array_join(F.transform("turns", part), "")
    loss = join(lambda t: t["loss"])
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(join(lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["chars"]).alias("formatted_chars"),
    )


# --- 10 ---------------------------------------------------------------------------------------

ACCEPT = 0.3  # score from which a document counts as good


def quality_scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score``; labels of held-out rows are not looked at."""
    vectors = quality.word_vectors(docs, "text")
    learn = labels.where(~quality.held_out(F.col("doc_id")))
    net = quality.train(docs, "doc_id", "text", learn, "doc_id", "quality", vectors)
    return quality.score(docs, "text", vectors, net, "score")


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scored(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


# --- 11 ---------------------------------------------------------------------------------------


@query(
    "op11_hard_negatives",
    """
    WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_inner_product(a.v, d.v)::BIGINT AS score
               FROM v a JOIN v d ON a.vec_id % 50 = 0 AND d.vec_id <> a.vec_id),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
                  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3""",
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(moved, "vec_id", "embedding", "label", F.col("vec_id") % 50 == 0, factor=256.0)


# --- 12 ---------------------------------------------------------------------------------------


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    columns = ("conv_id", "turn", "role", "text")
    found = repair.repair(repair.damage(rows, *columns), *columns)
    return repair.with_every(found, repair.originals(rows, "conv_id")).withColumnsRenamed({"conv": "conv_id", "sha256": "repaired_sha256"})


# --- 13 ---------------------------------------------------------------------------------------


@query("op13_quality_rules")
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = rules.train(docs, "doc_id", "text", table(spark, sf_dir, "labels"), "doc_id", "quality")
    return rules.judge(docs, "text", learned).select(
        "doc_id", *[f"rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")]
    )
