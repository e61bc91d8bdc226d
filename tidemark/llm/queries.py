"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from . import (bpe, decontam, hard_negatives, license_scan, packing, periodic, quality_classifier, quality_rules, secret_scan, simhash,
               substring_dedup, token_store, url_filter)
from .common import read_table, scratch_path

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.repeats_removed(read_table(spark, sf_dir, "documents")))


def op2_secret_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    return secret_scan.digest(secret_scan.scan(docs, model))


def op3_decontamination(spark, sf_dir):
    found = decontam.contamination(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return decontam.digest(found)


def op4_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.judge(spark, docs, quality_rules.fit(docs, read_table(spark, sf_dir, "labels")))


def op5_license_scan(spark, sf_dir):
    files = license_scan.documents_as_files(read_table(spark, sf_dir, "documents"))
    return license_scan.licences(spark, files).withColumnRenamed("file_id", "doc_id")


def op6_token_output(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    files = token_store.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return token_store.digest(token_store.read_tokens(spark, path, files, with_ids=False))


def op7_simhash_near_dedup(spark, sf_dir):
    return simhash.digest(simhash.near_duplicates(spark, read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3))


def op8_packing(spark, sf_dir):
    return packing.digest(packing.pack(spark, read_table(spark, sf_dir, "documents")))


def op9_url_filter(spark, sf_dir):
    return url_filter.digest(url_filter.judge(spark, read_table(spark, sf_dir, "pages"), URL_RULES))


def op10_quality_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = quality_classifier.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.score(spark, docs, model)


def op11_periodic_runs(spark, sf_dir):
    docs = periodic.with_planted_tails(read_table(spark, sf_dir, "documents"))
    return periodic.digest(periodic.periodic_runs(docs))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(spark, hard_negatives.contract_rows(read_table(spark, sf_dir, "embeddings")))


def op13_bpe(spark, sf_dir):
    return bpe.digest(bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents"))))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_token_output": op6_token_output,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_packing": op8_packing,
    "op9_url_filter": op9_url_filter,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_bpe": op13_bpe,
}

ORACLE = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS k
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w)),
least_doc AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least_doc USING (k) WHERE m < doc_id),
pos AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS p, unnest(ws) AS word FROM w),
spans AS (SELECT doc_id, count(*) AS n FROM hit h
          WHERE NOT EXISTS (SELECT 1 FROM hit g WHERE g.doc_id = h.doc_id AND g.p = h.p - 1) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
         FROM pos ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256, CAST(coalesce(spans.n, 0) AS BIGINT) AS n_spans
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
""",
    "op3_decontamination": r"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM lowered),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS k
       FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS k
       FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM w, lens)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN own USING (doc_id)
""",
    "op5_license_scan": r"""
WITH files AS (SELECT doc_id, text, concat_ws('/', source, lang,
    CASE WHEN regexp_matches(split_part(text, chr(10), 1), '(?i)licen[sc]|copyright|copyleft|creative commons|public domain|spdx')
         THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END) AS path FROM documents),
found AS (SELECT doc_id, s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM files)
    WHERE regexp_matches(s, '(?i)licen[sc]|copyright|copyleft|creative commons|public domain|spdx')
  UNION ALL SELECT doc_id, text FROM files WHERE path LIKE '%/LICENSE-%' AND text IS NOT NULL),
folded AS (SELECT s, count(*) AS n FROM found GROUP BY s),
tf AS (SELECT s, any_value(n) AS n, term, count(*) AS tf FROM (SELECT s, n, unnest(regexp_extract_all(
    translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS term FROM folded) GROUP BY s, term),
df AS (SELECT term, sum(n) AS df FROM tf GROUP BY term),
known(licence, t) AS (VALUES @@TEMPLATES@@),
ktf AS (SELECT licence, term, count(*) AS tf FROM (SELECT licence, unnest(regexp_extract_all(lower(t), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS term FROM known) GROUP BY ALL),
w AS (SELECT s, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM found)) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term)),
v AS (SELECT licence, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM found)) / (1 + coalesce(df, 0))) + 1) AS v FROM ktf LEFT JOIN df USING (term)),
wn AS (SELECT s, sqrt(sum(w * w)) AS wn FROM w GROUP BY s),
vn AS (SELECT licence, sqrt(sum(v * v)) AS vn FROM v GROUP BY licence),
cosines AS (SELECT s, licence, round(dot / (wn * vn), 6) AS c FROM
    (SELECT s, licence, sum(w * v) AS dot FROM w JOIN v USING (term) GROUP BY s, licence) JOIN wn USING (s) JOIN vn USING (licence)),
best AS (SELECT s, min({'least': -c, 'licence': licence}) AS best FROM cosines WHERE c >= 0.6 GROUP BY s),
own AS (SELECT doc_id, min(best) AS own FROM found JOIN best USING (s) GROUP BY doc_id),
places AS (SELECT doc_id, path, own, regexp_replace(path, '/?[^/]*$', '') AS folder FROM files LEFT JOIN own USING (doc_id)),
licensed AS (SELECT folder AS above, min(own) AS given FROM places WHERE path LIKE '%/LICENSE-%' AND own IS NOT NULL GROUP BY folder),
ups AS (SELECT folder, d, array_to_string(list_slice(string_split(folder, '/'), 1, d), '/') AS above
    FROM (SELECT folder, unnest(generate_series(0, len(string_split(folder, '/')))) AS d FROM (SELECT DISTINCT folder FROM places))),
nearest AS (SELECT folder, arg_max(above, d) AS above, arg_max(given, d) AS given FROM ups JOIN licensed USING (above) GROUP BY folder)
SELECT doc_id, path, coalesce(own, given).licence AS licence, -coalesce(own, given).least AS cosine,
       CASE WHEN own IS NOT NULL THEN 'header' WHEN given IS NOT NULL THEN 'folder' END AS via,
       CASE WHEN own IS NULL THEN above END AS folder
FROM places LEFT JOIN nearest USING (folder)
""",
    "op9_url_filter": r"""
WITH RECURSIVE p AS (SELECT page_id, url, html,
  CASE WHEN contains(coalesce(url, ''), '://') THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path,
  CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') END AS tail FROM pages),
rules(rule, rhost, rpath, verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
links AS (SELECT host || CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END AS a,
  regexp_extract(unnest(regexp_extract_all(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is')), 'href\s*=\s*["'']?[A-Za-z]+://([^"''\s>#]*)', 1, 'i') AS b
  FROM p WHERE tail IS NOT NULL),
edges AS (SELECT a, b FROM links WHERE b <> '' UNION SELECT b, a FROM links WHERE b <> ''),
reach AS (SELECT a AS x, a AS y FROM edges UNION SELECT x, b FROM reach JOIN edges ON y = a),
judged AS (SELECT y, arg_max(verdict, length(rule)) AS v FROM (SELECT DISTINCT y FROM reach) JOIN rules
  ON (split_part(y, '/', 1) = rhost OR ends_with(split_part(y, '/', 1), '.' || rhost)) AND starts_with(regexp_extract(y, '/[^?]*'), rpath) GROUP BY y),
bad AS (SELECT x FROM reach JOIN judged USING (y) GROUP BY x HAVING bool_or(v = 'block') AND NOT bool_or(v = 'allow')),
own AS (SELECT page_id, url, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS v FROM p JOIN rules
  ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id, url)
SELECT p.page_id, p.host, p.path, own.rule,
  coalesce(own.v, CASE WHEN bad.x IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN own ON p.page_id = own.page_id AND p.url = own.url
LEFT JOIN bad ON bad.x = p.host || CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END
""",
    "op12_hard_negatives": r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
      FROM e a JOIN e r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
pos AS (SELECT * FROM (SELECT anchor_id, id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth
                       FROM s WHERE same) WHERE nth <= 5),
neg AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS nth
        FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE nth <= 3
""",
}
ORACLE["op5_license_scan"] = ORACLE["op5_license_scan"].replace(
    "@@TEMPLATES@@", ", ".join(f"('{name}', '{text}')" for name, text in license_scan.TEMPLATES))
