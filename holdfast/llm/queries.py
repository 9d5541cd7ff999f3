"""The queries of this subpackage next to the SQL that checks them."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.catalog import query
from holdfast.llm.bpe import encode_texts
from holdfast.llm.filter_audit import audit_documents
from holdfast.llm.importance import resample
from holdfast.llm.jaccard_join import near_duplicates
from holdfast.llm.knn import top_k
from holdfast.llm.lexical_search import lexical_search
from holdfast.llm.line_dedup import drop_boilerplate, host_of, html_lines
from holdfast.llm.mixing import mix
from holdfast.llm.passages import passage_classes
from holdfast.llm.quality_rules import STOP_WORDS, judge
from holdfast.llm.secrets import KINDS, scan_secrets
from holdfast.llm.token_files import crc32, read_tokens, write_tokens
from holdfast.llm.url_rules import Rule, judge_urls
from holdfast.session import scratch_path, stage


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


OP8_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT doc_id, i, array_to_string(words[i:i+7], ' ') AS s
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             coalesce(cov.n, 0) AS n_repeat_words,
             len(regexp_extract_all(text, '\p{L}')) AS n_letters,
             len(list_filter(words, lambda x: list_contains([{stop}], x))) AS n_stop_words
      FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 1.5 * n_words OR word_chars > 20 * n_words OR n_symbols > n_words
            OR 2 * n_dup_lines > n_lines OR n_letters < 0.3 * word_chars
            OR (n_words >= 50 AND n_stop_words < 0.02 * n_words)) AS kept
FROM b"""


def _op8_sql() -> str:
    names = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    return OP8_SQL.replace("{stop}", ", ".join(f"'{w}'" for w in names))


@query("op8_quality_rules", _op8_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _spans(secrets):
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.filter("secrets", lambda s: s["kind"].isin(KINDS))
    return found.select("doc_id", *counts, F.sha2(_spans(base), 256).alias("base_sha256"),
                        _spans(F.col("secrets")).alias("spans"))


def _op2_row(c, ids: list[int]) -> dict:
    return {"n_tokens": len(ids), "ids_sha256": sha256(c.digits(ids).encode()).hexdigest(),
            "decoded_sha256": sha256(c.decode(ids).encode()).hexdigest()}


@query("op2_bpe_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_texts(documents(spark, sf_dir).select("doc_id", "text"), vocabulary("word_bpe_49k.json"), into="out",
                         finish=_op2_row, returns="struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    return coded.select("doc_id", "out.*")


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), folder, vocabulary("byte_bpe_50k.json"))
    return read_tokens(spark, folder, "ids_crc32", crc32, "long")


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(list_transform(string_split_regex(
           regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'),
           '(?:<[^>]*>|\n)+'), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
  FROM pages),
l AS (SELECT DISTINCT page_id, host, unnest(lines) AS line FROM p),
n AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
bad AS (SELECT l.host, line FROM l JOIN n ON n.host = l.host WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        GROUP BY l.host, line, pages HAVING count(*) >= 5 AND count(*) > 0.2 * pages),
b AS (SELECT host, list(line) AS bad FROM bad GROUP BY host),
k AS (SELECT page_id, p.host, lines, CASE WHEN bad IS NULL THEN lines
             ELSE list_filter(lines, lambda x: NOT list_contains(bad, x)) END AS kept FROM p LEFT JOIN b ON b.host = p.host)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped_lines,
       sha256(array_to_string(kept, chr(10))) AS text_sha256
FROM k"""


@query("op5_line_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written once: lines are counted first, then dropped, and taking them out of a page costs most.
    pages = stage(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", host_of().alias("host"), html_lines().alias("lines")), "lines")
    clean = drop_boilerplate(pages, F.col("host"), F.col("lines"))
    return clean.select("page_id", "host", "n_lines", "n_dropped_lines", F.sha2("text", 256).alias("text_sha256"))


@query("op6_source_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS w
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.w, v.w) AS BIGINT) AS score
      FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10"""


@query("op7_voronoi_top_k", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


@query("op9_importance_resampling")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    # As many documents are kept as the labels let expect good ones.
    counts = labels.agg(F.count("quality").alias("n"), F.sum("quality").alias("good")).first()
    share = counts["good"] / counts["n"] if counts["n"] else 1.0
    return resample(documents(spark, sf_dir).select("doc_id", "text"), good.select("doc_id"), share)


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@query("op4_shared_passages")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_classes(documents(spark, sf_dir))


#: Sites of the query, then patterns: pages of a shop or an account, copies of a page made for feeds, phones and sorting.
SITES = [Rule("org/", "allow", True), Rule("example.org/es/", "block", True), Rule("example.org/en/1", "block", True),
         Rule("com/fr/", "allow", True), Rule("com/de/", "block", True)]
PATTERNS = [Rule("/wp-admin/", "block"), Rule("/wp-login.php", "block"), Rule("/cart/", "block"), Rule("/checkout/", "block"),
            Rule("/login^", "block"), Rule("&sessionid=", "block"), Rule("^replytocom=", "block"), Rule("/robots.txt|", "allow"),
            Rule("?utm_source=feed|", "block"), Rule("|http://m.", "block"), Rule("://blog.*/en/*.html|", "block"),
            Rule("://m.*.net/fr/", "allow"), Rule("^page=*&ref=", "block"), Rule("|https://www.*/de/*#top|", "allow")]

OP11_SQL = r"""
WITH p AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN ends_with(u, '/robots.txt') OR regexp_matches(u, '(?s)://m\..*\.net/fr/')
       OR regexp_matches(u, '(?s)^https://www\..*/de/.*#top\z') THEN 'allow'
  WHEN contains(u, '/wp-admin/') OR contains(u, '/wp-login.php') OR contains(u, '/cart/') OR contains(u, '/checkout/')
       OR regexp_matches(u, '/login([^0-9a-z_.%-]|\z)') OR contains(u, '&sessionid=')
       OR regexp_matches(u, '([^0-9a-z_.%-]|\z)replytocom=') OR ends_with(u, '?utm_source=feed')
       OR starts_with(u, 'http://m.') OR regexp_matches(u, '(?s)://blog\..*/en/.*\.html\z')
       OR regexp_matches(u, '(?s)([^0-9a-z_.%-]|\z)page=.*&ref=') THEN 'block'
  ELSE 'allow' END AS verdict
FROM r"""


@query("op11_url_filters", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id"], [*SITES, *PATTERNS])
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


OP12_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN first < w.doc_id THEN 'E' ELSE '' END AS mask
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT '' AS o UNION ALL SELECT o || x FROM orders JOIN letters ON NOT contains(o, x)),
steps AS (SELECT o, step, substr(o, step, 1) AS x, substr(o, 1, step - 1) AS before
          FROM (SELECT o, unnest(range(1, 6)) AS step FROM orders WHERE length(o) = 5)),
m AS (SELECT part, o, step, x, n, good, toxic, contains(mask, x) AS fails, mask = x AS alone,
             before <> '' AND mask <> '' AND regexp_matches(mask, '[' || before || '_]') AS gone FROM c CROSS JOIN steps),
g AS (SELECT part, o, step, x, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost FROM m GROUP BY part, o, step, x)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM g"""


@query("op12_filter_audit", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
n AS (SELECT doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS N_docs, sum(n)::BIGINT AS L FROM n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM n)
       WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(N_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf CROSS JOIN total GROUP BY term),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * N_docs) // L))))::BIGINT AS score
      FROM q JOIN tf ON tf.term = q.term JOIN w ON w.term = q.term CROSS JOIN total GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50"""


@query("op13_lexical_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
