"""The thirteen registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import curriculum, decontaminate, embedding_dups, hard_negatives, jaccard, language_id, line_dedup, merkle, personal_data, token_counts, toxicity, url_reputation, warc
from shelfline.llm.common import remainder, table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    kept = line_dedup.dedup(line_dedup.create(docs), docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, folder, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy("position")


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(table(spark, folder, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages", "page_id", "url", "html"))


def op5_embedding_dups(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, folder, "embeddings", "vec_id", "embedding"))


def page_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled pages: the last number of a url's path names the document, which is good when of quality and not toxic."""
    pages = table(spark, folder, "pages", "page_id", "url")
    document = F.regexp_extract(url_reputation.path_of(F.col("url")), r"([0-9]{1,18})[^/0-9]*/?$", 1)
    named = pages.select("page_id", F.when(document != "", document.cast("long")).alias("doc_id")).where("doc_id IS NOT NULL")
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    good = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0)
    return named.join(labels, "doc_id").select("page_id", good.alias("good"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_reputation.judge(table(spark, folder, "pages", "page_id", "url"), page_outcomes(spark, folder))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "toxic").where(remainder("doc_id", 5) != 0)
    costs, marks = toxicity.train(docs, labels)
    scored = toxicity.score(docs, costs, marks)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, F.col("_score").alias("score")).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))
    return found.drop("spans")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.report(table(spark, folder, "documents", "doc_id", "text"), token_counts.model_bytes())


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    learned = language_id.profiles(docs.where(remainder("doc_id", 3) != 1).select("text", "lang"))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return language_id.predict(docs.select("doc_id", "text"), learned).select("doc_id", held_out, "_lang.lang_pred", "_lang.score")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return personal_data.report(docs, personal_data.learn(docs))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.document_manifest(table(spark, folder, "documents", *merkle.FIELDS))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_curriculum_mix, op3_ngram_jaccard, op4_warc, op5_embedding_dups, op6_url_filter, op7_toxicity,
        op8_decontaminate, op9_token_counts, op10_language_id,
        op11_hard_negatives, op12_personal_data, op13_merkle_manifest,
    )
}

_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _fields(*names: str) -> str:
    text = "CAST({0} AS VARCHAR)"
    return " || ".join(f"CASE WHEN {n} IS NULL THEN '-' ELSE octet_length(encode({text.format(n)})) || ':' || {text.format(n)} END" for n in names)


ORACLES = {
    "op1_line_dedup": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_ASCII}) AS k FROM lines),
many AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, many.k IS NOT NULL AND keyed.doc_id IS DISTINCT FROM top AS gone FROM keyed LEFT JOIN many USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r""",
    "op4_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest""",
    "op5_embedding_dups": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN comp ON vec_id = a""",
    "op8_decontaminate": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '{_TERMS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '{_TERMS}') AS w FROM benchmark WHERE item_id IS NOT NULL),
starts AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, w[k : k + n - 1] AS win FROM starts),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM windows)),
met AS (SELECT r, k, p.n AS n, item_id FROM (SELECT r, k, n, w[k : k + n - 1] AS win FROM places) p JOIN windows USING (n, win)),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS j FROM met) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM met) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)""",
    "op11_hard_negatives": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id AS other_id, b.r AS b, a.label = b.label AS alike, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)),
pos AS (SELECT a, anchor_id, other_id AS positive_id, b, score AS positive_score FROM met WHERE alike
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id, b) <= 5),
neg AS (SELECT p.*, m.other_id AS negative_id, m.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY m.score DESC, m.other_id, m.b) AS rank
  FROM pos p JOIN met m ON m.a = p.a AND NOT m.alike AND 80 * positive_score <= 100 * m.score AND 100 * m.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce('=' || lang, 'null') AS g,
  {_fields("doc_id", "source", "lang")} AS head, n_chars, {_fields("text")} AS tail FROM documents),
bits AS (SELECT r, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)) AS crc FROM t),
d AS (SELECT t.*, sha256(head || {_fields("n_chars")} || tail) AS leaf,
  CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL THEN sha256(head || octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1) || tail)
  ELSE sha256(head || {_fields("n_chars")} || tail) END AS held FROM t JOIN bits USING (r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, held) - 1 AS i FROM d),
low(g, h, i, node) AS (SELECT g, 0, i, leaf FROM placed UNION ALL
  SELECT g, h + 1, i // 2, sha256(node || coalesce(nxt, '')) FROM (
    SELECT *, lead(node) OVER (PARTITION BY g ORDER BY i) AS nxt, count(*) OVER (PARTITION BY g) AS n FROM low) WHERE n > 1 AND i % 2 = 0),
subroots AS (SELECT g, max(h) AS levels, arg_max(node, h) AS subroot FROM low GROUP BY g),
named AS (SELECT s.*, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS gi FROM subroots s JOIN (SELECT DISTINCT g, lang FROM t) USING (g)),
high(h, i, node) AS (SELECT 0, gi, subroot FROM named UNION ALL
  SELECT h + 1, i // 2, sha256(node || coalesce(nxt, '')) FROM (
    SELECT *, lead(node) OVER (ORDER BY i) AS nxt, count(*) OVER () AS n FROM high) WHERE n > 1 AND i % 2 = 0),
top AS (SELECT max(h) AS levels, arg_max(node, h) AS root FROM high),
steps AS (
  SELECT r, k AS step, xor(p.i >> k, 1) < (p.i >> k) AS on_left, node AS sibling
  FROM (SELECT r, g, i, unnest(range(levels)) AS k FROM placed JOIN named USING (g)) p
  LEFT JOIN low ON low.g = p.g AND low.h = k AND low.i = xor(p.i >> k, 1)
  UNION ALL
  SELECT r, below + k, xor(p.gi >> k, 1) < (p.gi >> k), node
  FROM (SELECT r, gi, named.levels AS below, unnest(range(top.levels)) AS k FROM placed JOIN named USING (g), top) p
  LEFT JOIN high ON high.h = k AND high.i = xor(p.gi >> k, 1)),
fold(r, step, node) AS (SELECT r, CAST(0 AS BIGINT), held FROM placed UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN sibling IS NULL THEN node WHEN on_left THEN sibling || node ELSE node || sibling END)
  FROM fold f JOIN steps s ON s.r = f.r AND s.step = f.step),
folded AS (SELECT r, arg_max(node, step) AS folded_root FROM fold GROUP BY r),
proofs AS (SELECT r, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN named USING (g) JOIN folded USING (r) LEFT JOIN proofs USING (r), top""",
}
