"""The named queries of this subpackage, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import decontaminate, fingerprints, licenses, lmscore, neardup, packing, pieces, repair, repeats, secrets, toxicity, trie, urls
from corpusloom.sources.tables import read_table

#: The files of the tokenizer and of the pieces in the folder of public tokenizers.
TOKENIZER, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, cut into pieces that fill sequences of 2048."""
    packed = packing.pack(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), tokenizer_path())
    return packed.withColumnRenamed("row", "doc_id")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness to it and to the next text."""
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = fingerprints.fingerprints_with_next(documents, fingerprints.lexicon(documents))
    shown = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return found.select(F.col("row").alias("doc_id"), "n_chars", "edited_sha256", *shown, "near_edited", "near_next")


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document by the counts of all documents."""
    found = lmscore.backoff_scores(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return found.select(F.col("row").alias("doc_id"), "n_words", F.round("log_score", 3).alias("log_score"))


OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w FROM documents),
steps AS (SELECT doc_id, CASE WHEN i > 1 THEN w[i - 1] END AS a, w[i] AS b FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
words AS (SELECT b AS word, count(*) AS n FROM steps GROUP BY 1),
pairs AS (SELECT a, b, count(*) AS n FROM steps WHERE a IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
scores AS (
  SELECT s.doc_id, CASE WHEN p.n IS NOT NULL THEN ln(p.n / h.n) ELSE ln(w.n / (SELECT sum(n) FROM words)) + CASE WHEN s.a IS NULL THEN 0 ELSE ln(0.4) END END AS s
  FROM steps s LEFT JOIN pairs p ON s.a = p.a AND s.b = p.b LEFT JOIN words h ON s.a = h.word JOIN words w ON s.b = w.word)
SELECT doc_id, len(w) AS n_words, coalesce(round(t, 3), 0) AS log_score FROM docs LEFT JOIN (SELECT doc_id, sum(s) AS t FROM scores GROUP BY 1) USING (doc_id)
"""


def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence that an entire text is, and those that its lines are, by canonical digests."""
    known = spark.createDataFrame(licenses.KNOWN, "license_id string, text string")
    found = licenses.license_hits(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), known)
    return found.select("doc_id", "canonical_sha256", "whole_license", F.array_join("license_lines", ",").alias("license_lines"), "n_license_lines")


def _canonical_sql(text: str) -> str:
    plain = f"regexp_replace(lower({text}), '{licenses.COPYRIGHT_LINE}', '', 'g')"
    for one, other in licenses.SPELLINGS:
        plain = f"replace({plain}, '{one}', '{other}')"
    return f"trim(regexp_replace({plain}, '{licenses.PUNCTUATION}', ' ', 'g'))"


OP4_SQL = f"""
WITH known AS (SELECT sha256({_canonical_sql('t')}) AS digest, id FROM (VALUES {', '.join(f"('{i}', '{t}')" for i, t in licenses.KNOWN)}) k(id, t)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs),
hits AS (SELECT rid, id FROM (SELECT rid, sha256({_canonical_sql('line')}) AS digest FROM lines) JOIN known USING (digest)),
per AS (SELECT rid, count(*) AS n, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM hits GROUP BY rid),
whole AS (SELECT rid, doc_id, sha256({_canonical_sql('text')}) AS canonical_sha256 FROM docs)
SELECT doc_id, canonical_sha256, id AS whole_license, coalesce(ids, '') AS license_lines, coalesce(n, 0) AS n_license_lines
FROM whole LEFT JOIN known ON digest = canonical_sha256 LEFT JOIN per USING (rid)
"""


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, which arrive in two deliveries: the second is scanned against the ledger of the first."""
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    later = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    first = secrets.scan(documents.filter(~later), "doc_id")
    ledger = first.unionByName(secrets.scan(documents.filter(later), "doc_id", ledger=first))
    found = secrets.findings(documents, ledger)
    base = F.filter("secrets", lambda s: s["kind"].isin([r.kind for r in secrets.BASE_RULES]))
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(r.kind) for r in secrets.BASE_RULES], F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets")).alias("spans"),
    )


OP5_SQL = r"""
WITH rules(kind, rank, least) AS (VALUES ('assign', 0, 8), ('access', 1, 16), ('hex', 2, 32)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT rid, kind, rank, least, regexp_extract_all(text, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS whole,
    regexp_extract_all(text, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS value,
    string_split_regex(text, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?(?:[A-Za-z0-9+/_.=-]+)') AS gaps FROM docs, rules WHERE kind = 'assign'
  UNION ALL SELECT rid, kind, rank, least, regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0), string_split_regex(text, 'AKIA[A-Z0-9]+')
    FROM docs, rules WHERE kind = 'access'
  UNION ALL SELECT rid, kind, rank, least, regexp_extract_all(text, '[0-9a-f]{32,}', 0), regexp_extract_all(text, '[0-9a-f]{32,}', 0), string_split_regex(text, '[0-9a-f]{32,}')
    FROM docs, rules WHERE kind = 'hex'),
each AS (SELECT rid, kind, rank, least, unnest(range(1, len(whole) + 1)) AS i, whole, value, gaps FROM parts),
spans AS (
  SELECT rid, kind, rank, least, length(value[i]) AS n, length(whole[i]) AS w,
    sum(length(whole[i]) + length(gaps[i])) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM each),
good AS (SELECT rid, kind, rank, stop - w AS start, kind || ':' || CAST(stop - w AS VARCHAR) || ':' || CAST(stop AS VARCHAR) AS span FROM spans WHERE n >= least),
texts AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, rank) AS spans FROM good GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN texts USING (rid)
"""


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document, from a similarity of 0.85."""
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"])).withColumnRenamed("row", "doc_id")


OP6_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))]
    ELSE list_distinct([hash(array_to_string(w[i:i + 4], ' ')) for i in range(1, len(w) - 3)]) END AS s FROM docs),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least_id USING (doc_id)
"""


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that go because a window of 35 of them occurs twice, and the digest of the rest."""
    kept = repeats.without_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
starts AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
again AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM starts JOIN again USING (h)),
removed AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid),
words AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs WHERE rid IN (SELECT rid FROM removed)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(t, '') END) AS kept_sha256
FROM docs LEFT JOIN removed USING (rid) LEFT JOIN kept USING (rid)
"""


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items, and the items."""
    judged = decontaminate.contamination(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated",
    )


OP8_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM items WHERE len(w) > 0),
starts AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM starts),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n),
grams AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM places),
hits AS (SELECT rid, i, g.n, item_id FROM grams g JOIN windows v ON g.n = v.n AND g.win = v.win),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM docs LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""

#: The rules of the URL query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page by the longest rule that fits."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.judge_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]), rules)
    return judged.select(
        "page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict")
    )


OP9_SQL = r"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS after FROM pages),
parts AS (
  SELECT rid, page_id, translate(regexp_extract(after, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (
  SELECT rid, rule_host || rule_path AS rule, r.verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS best
  FROM parts p JOIN rules r ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM fit WHERE best = 1) USING (rid)
"""

def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a model of the labelled ones that are not held out."""
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    rated = toxicity.scored(documents, toxicity.fitted(documents, read_table(spark, sf_dir, "labels")))
    return rated.select("doc_id", toxicity.held_out().alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_predicted").alias("predicted"))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text that is not empty; the engine of the SQL has no function for it."""
    return (
        f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT)), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1))), 4294967295::BIGINT), 4294967295)"
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations, with the sums of their subtrees."""
    return trie.conversation_trie(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))


#: Keys are the digests of the turns so far; what lies below a node is found by the beginnings of each node's smallest member.
OP11_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rn
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.rn, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.rn <= c.h
  UNION ALL SELECT c.conv_id, 1, t.rn, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.rn > c.h),
placed AS (SELECT conv_id, text, md5(role) || md5(text) AS turn, row_number() OVER (PARTITION BY conv_id ORDER BY part, rn) AS depth FROM rebuilt),
members AS (
  SELECT conv_id, depth, length(text) AS size, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ends AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM members
  WHERE depth = (SELECT max(depth) FROM members m WHERE m.conv_id = members.conv_id) GROUP BY key),
nodes AS (SELECT key, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved FROM members GROUP BY key),
linked AS (SELECT n.*, p.key AS parent, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, 64 * (n.depth - 1)) ),
kids AS (SELECT parent AS key, count(*) AS n FROM linked WHERE depth > 0 GROUP BY parent),
below AS (
  SELECT m.key, sum(n.saved) AS saved, count(*) FILTER (k.n IS NULL) AS leaves FROM nodes n LEFT JOIN kids k USING (key) JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.key)
SELECT l.conv_id, l.depth, parent_conv_id, n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves, b.saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM linked l JOIN below b USING (key) LEFT JOIN kids USING (key) LEFT JOIN ends USING (key)
"""


def op12_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    found = repair.repaired(repair.damaged(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])), "present")
    return found.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(repair.lines("repaired"), 256).alias("repaired_sha256")
    )


#: The best repair for each state of the grammar (E empty, S system, U user, A assistant last), turn by turn.
OP12_SQL = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM keyed WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM damaged),
judged AS (
  SELECT *, substr(role, 1, 1) AS r, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS before,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS f FROM placed),
pre(f, st, c, a, t) AS (VALUES ('E', 'E', 0, '', ''), ('S', 'S', 0, '', ''), ('U', 'U', 0, '', ''), ('A', 'A', 0, '', ''),
  ('E', 'U', 5, 'I', chr(10) || 'user:'), ('S', 'U', 5, 'I', chr(10) || 'user:'), ('A', 'U', 5, 'I', chr(10) || 'user:'), ('U', 'A', 5, 'I', chr(10) || 'assistant:'),
  ('E', 'A', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('S', 'A', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
act(f, a, need, st, role) AS (VALUES ('E', 'D', '', 'E', ''), ('S', 'D', '', 'S', ''), ('U', 'D', '', 'U', ''), ('A', 'D', '', 'A', ''),
  ('E', 'K', 's', 'S', ''), ('E', 'K', 'u', 'U', ''), ('S', 'K', 'u', 'U', ''), ('A', 'K', 'u', 'U', ''), ('U', 'K', 'a', 'A', ''),
  ('E', 'R', 'u', 'U', 'user'), ('S', 'R', 'u', 'U', 'user'), ('A', 'R', 'u', 'U', 'user'), ('U', 'R', 'a', 'A', 'assistant')),
run(conv_id, i, st, b) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 'E', {{'c': 0::BIGINT, 'a': '', 't': ''}} FROM conversations
  UNION ALL
  SELECT run.conv_id, run.i + 1, act.st, min({{
    'c': run.b.c + pre.c + CASE act.a WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN j.f = 'truncated' AND act.a <> 'D' THEN 5 ELSE 0 END,
    'a': run.b.a || pre.a || act.a,
    't': run.b.t || pre.t || CASE act.a WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || j.role || ':' || j.text ELSE chr(10) || act.role || ':' || j.text END}})
  FROM run JOIN judged j ON j.conv_id IS NOT DISTINCT FROM run.conv_id AND j.rn = run.i + 1 JOIN pre ON pre.f = run.st JOIN act ON act.f = pre.st
    AND (act.a = 'D' OR (j.f NOT IN ('blank', 'duplicate') AND (act.a = 'K') = (j.r = act.need)))
  GROUP BY run.conv_id, run.i, act.st),
sums AS (
  SELECT c.conv_id, count(rn) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'blank') AS blank,
    count(*) FILTER (f = 'duplicate') AS duplicate, count(*) FILTER (f = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN judged ON c.conv_id IS NOT DISTINCT FROM judged.conv_id GROUP BY c.conv_id),
best AS (
  SELECT s.conv_id, min({{'c': b.c + pre.c, 'a': b.a || pre.a, 't': b.t || pre.t}}) AS b FROM sums s JOIN run ON run.conv_id IS NOT DISTINCT FROM s.conv_id AND run.i = s.n
  JOIN pre ON pre.f = run.st AND pre.st IN ('E', 'A') GROUP BY s.conv_id)
SELECT s.conv_id, gaps, blank, duplicate, truncated, illegal, b.c AS cost, b.a AS audit, sha256(substr(b.t, 2)) AS repaired_sha256
FROM sums s JOIN best ON s.conv_id IS NOT DISTINCT FROM best.conv_id
"""


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the piece ids of every whole text, and digest of the text they give again."""
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    coded = pieces.encode(documents, tokenizer_path(PIECES), decoded="decoded_text", keep=["doc_id"])
    return coded.select(
        "doc_id", F.size("piece_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded_text", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_packing": (op1_packing, None),
    "op2_fingerprints": (op2_fingerprints, None),
    "op3_lm_scores": (op3_lm_scores, OP3_SQL),
    "op4_license_digests": (op4_license_digests, OP4_SQL),
    "op5_secret_ledger": (op5_secret_ledger, OP5_SQL),
    "op6_near_duplicates": (op6_near_duplicates, OP6_SQL),
    "op7_repeated_passages": (op7_repeated_passages, OP7_SQL),
    "op8_decontamination": (op8_decontamination, OP8_SQL),
    "op9_url_filter": (op9_url_filter, OP9_SQL),
    "op10_toxicity": (op10_toxicity, None),
    "op11_conversation_trie": (op11_conversation_trie, OP11_SQL),
    "op12_repaired_conversations": (op12_repaired_conversations, OP12_SQL),
    "op13_sentencepiece": (op13_sentencepiece, None),
}
