"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, decontam, fim, ngramjoin, pieces, shards, sketch, suffix, tokencounts, toxicity, urlfilter, warc
from .shared import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a 10-word window of a benchmark item."""
    found = decontam.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document in 50-byte strings that an earlier document has too."""
    found = suffix.repeats(_table(spark, sf_dir, "documents"))
    kept = F.col("kept")
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length(kept)).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))


PIECES = os.environ.get("BRINDLE_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str = PIECES) -> DataFrame:
    """Each document's ids, and whether they decode to its text."""
    vocabulary = pieces.load(model_file)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    same = F.col("decoded").eqNullSafe(F.translate("text", pieces.MARK, " "))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), same.alias("exact"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's chance to be toxic, from a model that the held-out fifth had no part in."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


SITE_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's verdict by the five site rules, else by the method's own patterns."""
    rules = [*(urlfilter.site_rule(*r) for r in SITE_RULES), *urlfilter.PATTERNS]
    return urlfilter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shard of 8 and its place there; the law is that sizes are near equal."""
    placed = shards.assign(_table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


CONTROL = "<|im_end|><|im_start|>assistant ok"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted examples of each conversation say when they are read back."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    examples = chat.expand(turns.unionByName(probe))
    whole = F.concat("context", "target")
    back = F.when(F.col("example") == F.col("n_examples"), chat.parse(whole))  # the last example has all turns
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    rows = examples.withColumns({"turns": back, "reply": chat.loss_text(whole, F.col("loss_start"), F.col("loss_end")), "n": F.char_length(whole)})
    rows = rows.select("conv_id", "example", F.size("turns").alias("n_turns"), F.when(F.col("turns").isNotNull(), F.sha2(said.cast("binary"), 256)).alias("sha"), "reply", "n")
    per = rows.groupBy("conv_id").agg(F.max(F.when(F.col("sha").isNotNull(), F.col("n_turns"))).cast("long").alias("n_turns"), F.array_max(F.collect_list("sha")).alias("turns_sha256"), F.array_sort(F.collect_list(F.struct("example", "reply"))).alias("replies"), F.sum("n").cast("long").alias("formatted_chars"))
    text = F.concat_ws("", F.col("replies.reply"))
    return per.select("conv_id", "n_turns", "turns_sha256", F.char_length(text).cast("long").alias("loss_chars"), F.sha2(text.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and its likeness to that of an edited text and of the next document."""
    return sketch.against_next(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of documents linked at a Jaccard similarity of 0.8 or more of 5-word shingles, and its number of links."""
    return ngramjoin.join(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "n_links")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives say of each page when its record is found in the capture index and read by its range."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    pages = _table(spark, sf_dir, "pages")
    warc.write(pages.select("page_id", "url", "html"), folder)
    warc.index(warc.read(spark, folder, payloads=False), f"{folder}-index")
    found = warc.captures(pages.select("page_id", "url"), f"{folder}-index")
    return warc.fetch_all(found, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document cut at two places between words or other characters, its middle moved to the end, and put together again."""
    made = fim.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    chars = lambda c: F.char_length(c).cast("long").alias(f"{c}_chars")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    restored = fim.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", F.col("units").alias("n"), "form", chars("prefix"), chars("middle"), sha(F.col("output")).alias("output_sha256"), sha(restored).alias("restored_sha256"))


def op12_token_counts(spark: SparkSession, sf_dir: str, model_file: str = PIECES) -> DataFrame:
    """Each document's tokens, and whether they are more than 4096."""
    return tokencounts.count(_table(spark, sf_dir, "documents").select("doc_id", "text"), pieces.load(model_file)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's cluster after three exact rounds over 16 centroids."""
    made = centroids.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return made.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_sharding": op6_sharding,
    "op7_chat_format": op7_chat_format,
    "op8_fingerprints": op8_fingerprints,
    "op9_ngram_join": op9_ngram_join,
    "op10_warc": op10_warc,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_counts": op12_token_counts,
    "op13_centroids": op13_centroids,
}

# rounds of the clustering: from the centroids of one to those of the next
_NEAREST = """a{k} AS MATERIALIZED (SELECT id, r, x, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT kept.id, kept.r, kept.x, c, list_sum(list_transform(list_zip(kept.x, c{k}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept, c{k}) GROUP BY id, r, x)"""
_MOVED = """s{k} AS (SELECT c, j, sum(x[j]) AS s, count(*) AS n FROM a{k}, unnest(range(1, 65)) AS t(j) GROUP BY c, j),
c{n} AS MATERIALIZED (SELECT c, coalesce(m.x, c{k}.x) AS x FROM c{k} LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS HUGEINT) ORDER BY j) AS x FROM s{k} GROUP BY c) AS m USING (c))"""

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op11_fill_in_middle": """
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS ws, sha256(concat('1:', doc_id)) AS s FROM documents),
h AS (SELECT *, len(ws) AS n, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2, CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM u),
f AS (SELECT doc_id, t, n, ws, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (SELECT doc_id, t, n, form, array_to_string(ws[1:a], '') AS p, array_to_string(ws[a + 1:b], '') AS m, array_to_string(ws[b + 1:n], '') AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c""",
    "op13_centroids": f"""
WITH kept AS MATERIALIZED (SELECT vec_id AS id, row_number() OVER () AS r, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS HUGEINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256(concat('1:', id)), x) - 1 AS c, x FROM kept QUALIFY c < 16),
{", ".join(f"{_NEAREST.format(k=k)}, {_MOVED.format(k=k, n=k + 1)}" for k in range(3))}, {_NEAREST.format(k=3)},
i AS (SELECT c, sum(d) AS ci FROM a3 GROUP BY c)
SELECT id AS vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(ci AS BIGINT) AS cluster_inertia, CAST((SELECT sum(d) FROM a3) AS BIGINT) AS inertia,
  sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN i USING (c) JOIN c3 USING (c)""",
    "op1_decontamination": f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[k:k + least(10, len(ws)) - 1], ' ') AS w
  FROM items, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS t(k) WHERE len(ws) > 0),
docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM wins),
cand AS (SELECT doc_id, n, k, array_to_string(ws[k:k + n - 1], ' ') AS w FROM docs, sizes, unnest(range(1, len(ws) - n + 2)) AS t(k)),
hits AS (SELECT doc_id, c.n, k, item FROM cand AS c JOIN wins USING (n, w)),
per AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS its FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(its), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(its, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN per USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op9_ngram_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({_WORDS}, []) AS ws, coalesce(text, '') AS t FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS s FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS r(k) WHERE len(ws) > 0 UNION ALL SELECT doc_id, chr(10) || t FROM w WHERE len(ws) = 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh AS a JOIN sh AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT x, y FROM pairs JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y WHERE c >= 0.8 * (p.n + q.n - c) - 1e-9),
both_ways AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach(x, root) AS (SELECT DISTINCT x, x FROM both_ways UNION SELECT b.y, r.root FROM reach AS r JOIN both_ways AS b ON b.x = r.x),
classes AS (SELECT x, min(root) AS class_id FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM both_ways GROUP BY x)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id, coalesce(n, 0) AS n_links FROM w LEFT JOIN classes ON classes.x = w.doc_id LEFT JOIN counts ON counts.x = w.doc_id""",
    "op10_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages),
digits AS (SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    ((CAST('0x' || substr(h, 2 * ((5 * k) // 8) + 1, 2) AS INTEGER) * 256 + CASE WHEN (5 * k) // 8 < 19 THEN CAST('0x' || substr(h, 2 * ((5 * k) // 8) + 3, 2) AS INTEGER) ELSE 0 END)
      >> (11 - (5 * k) % 8)) & 31 AS INTEGER) + 1, 1), '' ORDER BY k) AS d
  FROM (SELECT DISTINCT h FROM p), unnest(range(0, 32)) AS r(k) GROUP BY h),
firsts AS (SELECT h, min(page_id) AS f FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM p JOIN firsts USING (h) JOIN digits USING (h)""",
    "op5_url_filter": """
WITH src AS (SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS low,
  translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM src),
rules(name, h, pre, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
best AS (SELECT page_id, arg_max(name, length(name)) AS rule, arg_max(verdict, length(name)) AS v FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(low, '^[a-z][a-z0-9+.-]*://([^/?#]*[.-])?(betting|casino|malware|phishing|poker|porn|sex|slots|spam|viagra|warez|xxx)[.-]') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (page_id)""",
    "op7_chat_format": """
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n,
  length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) AS esc, length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;')) AS rl FROM rows),
sized AS (SELECT *, sum(esc + rl + 24) OVER (PARTITION BY conv_id ORDER BY k) AS upto, max(CASE WHEN role = 'assistant' THEN k END) OVER (PARTITION BY conv_id) AS last FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (WHERE role = 'assistant'), 0) + CASE WHEN coalesce(max(last), 0) < max(n) THEN max(upto) ELSE 0 END AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op2_suffix_dedup": """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
pos AS (SELECT doc_id, k, b[k + 1:k + 50] AS w FROM docs, unnest(range(0, octet_length(b) - 49)) AS r(k)),
firsts AS (SELECT w, min(doc_id) AS d FROM pos GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, k FROM pos JOIN firsts USING (w) WHERE d < doc_id),
runs AS (SELECT doc_id, k, sum(CASE WHEN k <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY k) AS run
  FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM hits)),
spans AS (SELECT doc_id, run, min(k) AS s, max(k) + 50 AS e FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM spans),
per AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last, string_agg(hex(b[before + 1:s]), '' ORDER BY s) AS head FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || hex(b[coalesce(last, 0) + 1:octet_length(b)]))) AS kept_sha256
FROM docs LEFT JOIN per USING (doc_id)""",
}
