"""Registered queries of the training-data operators: name -> (function of session and folder, SQL or None)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import ann_search, bpe, decontaminate, langid, license_scan, mixing, near_dup, quality_rules, token_tree, toxicity, url_rules, whitening, word_runs
from .common import WORD_PATTERN, fold, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer(ranks: str = RANKS) -> tuple[str, str]:
    """(path of the rank file, pattern that cuts texts into pieces)."""
    import public_tokenizers

    return public_tokenizers.path(ranks), public_tokenizers.PATTERN


def op1_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every vector whose id is divisible by 20."""
    return ann_search.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    return decontaminate.leaks(table(spark, sf_dir, "documents", "doc_id", "text"),
                               table(spark, sf_dir, "benchmark", "item_id", "text"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page address."""
    return url_rules.url_verdicts(table(spark, sf_dir, "pages", "page_id", "url")).drop("pattern")


def three_edits() -> Column:
    """Three edits of each document, drawn from its id and text: a cut, a passage repeated elsewhere, a new heading."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    spot = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(n)), size + 1)
    again = F.substring("text", (spot(2) + 1).cast("int"), F.lit(24))
    return token_tree.edit_list((spot(1), F.lit(12), F.lit("")), (spot(3), F.lit(0), again), (F.lit(0), F.lit(0), F.lit("Revised:\n")))


def op4_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its edits, and how many pieces were encoded for them."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", "text", three_edits().alias("edits"))
    return token_tree.count_with_edits(docs, *tokenizer()).drop("edited_text")


def op5_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and keep decision of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the fold crc32 mod 4 = 2."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_rules.score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= quality_rules.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes for every document."""
    coded = bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), *tokenizer(), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_kn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside the fold crc32 mod 3 = 1."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return license_scan.scan(docs, license_scan.train(docs))


def op10_gru_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the fold crc32 mod 3 = 1."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix of all documents takes of each, with its source's size and target."""
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).taken()


def with_repeated_tail(text: Column, doc_id: Column) -> Column:
    """The text whose words from number a on repeat the p words there, for ids with crc32 mod 10 = 0: a and p come
    from the rest of the crc32 and the number of words; other texts as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    n = F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    tail = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    changed = F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), F.lit(1), n.cast("int"))
    return F.when((h % 10 == 0) & (F.size(words) > 0), F.array_join(changed, " ")).otherwise(text)


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document (a tenth of them with repeated tails): number, strongest run, digests of all
    runs and of the text with runs cut to one period."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = word_runs.find_runs(docs.select("doc_id", with_repeated_tail(F.col("text"), F.col("doc_id")).alias("text")))
    best = word_runs.strongest(F.col("runs"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(word_runs.run_lines(F.col("runs")), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")) \
        .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding, up to 16 components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


_ADDRESS = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHAPE = "'^.*?://([^/?#]*)([^?#]*)'"
_FITS = ["('" + r.text + "', '" + r.action + "', '" + r.text.partition("/")[0] + "', '/" + r.text.partition("/")[2] + "')"
         for r in url_rules.SITE_RULES]
_PATTERNS = " OR ".join(f"regexp_matches(address, '{r.regex}')" for r in url_rules.PATTERN_RULES)
OP3_SQL = f"""
WITH parts AS (
  SELECT page_id, {_ADDRESS} AS address, regexp_extract({_ADDRESS}, {_SHAPE}, 1, 's') AS host,
         regexp_extract(coalesce(url, ''), {_SHAPE}, 2, 's') AS path, row_number() OVER () AS n
  FROM pages),
rules(rule, verdict, site, prefix) AS (VALUES {", ".join(_FITS)}),
best AS (
  SELECT n, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix) GROUP BY n)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN {_PATTERNS} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (n)"""

OP5_SQL = """
WITH RECURSIVE
lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM lowered),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
alike AS (
  SELECT s, row_number() OVER () AS k, min(doc_id) AS first_id, len(s) AS n
  FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0 AND doc_id IS NOT NULL) GROUP BY s),
members AS (SELECT k, n, unnest(s) AS x FROM alike),
common AS (
  SELECT a.k AS a, b.k AS b, any_value(a.n) AS n1, any_value(b.n) AS n2, count(*) AS c
  FROM members a JOIN members b ON a.x = b.x AND a.k < b.k AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.k, b.k),
links AS (SELECT a, b FROM common WHERE 100 * c >= 75 * (n1 + n2 - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, root) AS (SELECT k, k FROM alike UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node AND r.root < e.b),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
named AS (SELECT k, min(first_id) OVER (PARTITION BY root) AS component FROM alike JOIN roots ON node = k)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, CASE WHEN d.doc_id IS NOT NULL THEN coalesce(n.component, d.doc_id) END AS component_id,
       coalesce(d.doc_id = coalesce(n.component, d.doc_id), true) AS kept
FROM sets d LEFT JOIN alike a ON a.s = list_sort(d.s) AND len(d.s) > 0 LEFT JOIN named n ON n.k = a.k"""

REGISTRY = {
    "op1_multiprobe_ann": (op1_multiprobe_ann, None),
    "op2_qgram_decontamination": (op2_qgram_decontamination, None),
    "op3_url_rules": (op3_url_rules, OP3_SQL),
    "op4_edit_token_counts": (op4_edit_token_counts, None),
    "op5_bbit_minhash": (op5_bbit_minhash, OP5_SQL),
    "op6_rule_quality": (op6_rule_quality, None),
    "op7_byte_bpe": (op7_byte_bpe, None),
    "op8_kn_toxicity": (op8_kn_toxicity, None),
    "op9_license_scan": (op9_license_scan, None),
    "op10_gru_langid": (op10_gru_langid, None),
    "op11_source_mix": (op11_source_mix, None),
    "op12_word_runs": (op12_word_runs, None),
    "op13_whitening": (op13_whitening, None),
}
