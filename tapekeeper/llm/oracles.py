"""SQL that DuckDB runs on the same tables, for the queries it can express."""

from tapekeeper.llm.lexical import TERM as WORD
from tapekeeper.llm.licenses import LEAST, NAMING, TEMPLATES, TERM, needed_terms

TEMPLATE_ROWS = ", ".join(
    f"({k}, '{t.license}', '{t.text}', {t.title}, {needed_terms(t.text)}::VARCHAR[])" for k, t in enumerate(TEMPLATES))

ORACLES = {
    "op5_exact_dedup": """
WITH low AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM low WINDOW same AS (PARTITION BY text_sha256)
""",
    "op3_preferences": """
WITH t AS (
  SELECT conv_id, turn, replace(coalesce(role, ''), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
cuts AS (SELECT conv_id AS pair_id, count(*) // 2 AS cut FROM t GROUP BY 1),
sides AS (
  SELECT 'c' AS side, conv_id AS pair_id, turn, role, text FROM t
  UNION ALL SELECT 'r', pair_id, turn, role, text FROM t JOIN cuts ON conv_id = pair_id WHERE turn < cut
  UNION ALL SELECT 'r', pair_id, turn, role, text FROM t JOIN cuts ON xor(conv_id, 1) = pair_id WHERE turn >= cut),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY side, pair_id ORDER BY turn, role, text) AS nth,
         '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body FROM sides),
unequal AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, min(coalesce(c.nth, r.nth)) AS nth
  FROM (SELECT * FROM placed WHERE side = 'c') c FULL JOIN (SELECT * FROM placed WHERE side = 'r') r
    ON c.pair_id = r.pair_id AND c.nth = r.nth
  WHERE c.nth IS NULL OR r.nth IS NULL OR c.role <> r.role OR c.text <> r.text GROUP BY 1),
marked AS (
  SELECT placed.*, coalesce(unequal.nth, 1e18) AS fork,
         length(head) || '- ' || length(body) || CASE WHEN role = 'assistant' THEN '+' ELSE '-' END AS mask
  FROM placed LEFT JOIN unequal USING (pair_id))
SELECT pair_id, CAST(count(*) FILTER (side = 'c' AND nth < fork) AS INTEGER) AS prefix_turns,
       coalesce(string_agg(head || body, '' ORDER BY nth) FILTER (side = 'c' AND nth < fork), '') AS prompt,
       coalesce(string_agg(head || body, '' ORDER BY nth) FILTER (side = 'c' AND nth >= fork), '') AS chosen,
       coalesce(string_agg(mask, ' ' ORDER BY nth) FILTER (side = 'c' AND nth >= fork), '') AS chosen_mask,
       coalesce(string_agg(head || body, '' ORDER BY nth) FILTER (side = 'r' AND nth >= fork), '') AS rejected,
       coalesce(string_agg(mask, ' ' ORDER BY nth) FILTER (side = 'r' AND nth >= fork), '') AS rejected_mask,
       count(*) FILTER (nth >= fork) > 0 AS differs
FROM marked GROUP BY pair_id
""",
    "op6_licenses": f"""
WITH t(template, license, notice, title, needed) AS (VALUES {TEMPLATE_ROWS}),
tlist AS (SELECT *, regexp_extract_all(lower(notice), '{TERM}') AS terms FROM t),
tcount AS (SELECT template, license, term, count(*) AS n FROM (SELECT template, license, unnest(terms) AS term FROM tlist) GROUP BY ALL),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM t)) / (1.0 + count(*))) + 1 AS idf FROM tcount GROUP BY 1),
tw AS (SELECT template, license, term, n * idf AS w FROM tcount JOIN idf USING (term)),
tl AS (SELECT template, sqrt(sum(w * w)) AS size FROM tw GROUP BY 1),
known AS (
  SELECT template, title, needed, len(terms) AS length, list_distinct(terms) AS own,
         list_filter({NAMING}::VARCHAR[], lambda x: NOT list_contains(terms, x)) AS others FROM tlist),
files AS (
  SELECT row_number() OVER () AS r, doc_id, source || '/p' || (doc_id // 100) AS package,
         replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'licence', 'license') AS low,
         package || '/' || (doc_id // 10 % 10) AS folder,
         CASE WHEN doc_id % 100 = 55 THEN package || '/COPYING' WHEN doc_id % 10 = 0 THEN folder || '/LICENSE'
              ELSE folder || '/' || doc_id || '.txt' END AS path,
         CASE WHEN doc_id % 100 = 55 THEN package ELSE folder END AS dir,
         doc_id % 100 = 55 OR doc_id % 10 = 0 AS whole
  FROM documents),
split AS (SELECT r, whole, regexp_extract_all(low, '{TERM}') AS terms FROM files),
near AS (
  SELECT r, k.*, terms FROM split JOIN known k ON list_has_all(terms, needed) AND (whole OR NOT title)),
places AS (SELECT *, unnest(range(1, len(terms) - length + 2)) AS place FROM near),
passages AS (
  SELECT row_number() OVER () AS p, r, template, list_slice(terms, place, place + length - 1) AS terms FROM places
  WHERE list_contains(own, terms[place]) AND list_has_all(list_slice(terms, place, place + length - 1), needed)
    AND NOT list_has_any(list_slice(terms, place, place + length - 1), others)),
pcount AS (SELECT p, r, template, term, count(*) AS n FROM (SELECT p, r, template, unnest(terms) AS term FROM passages) GROUP BY ALL),
pw AS (SELECT p, r, template, term, n * coalesce(idf, ln(1 + (SELECT count(*) FROM t)) + 1) AS w FROM pcount LEFT JOIN idf USING (term)),
pl AS (SELECT p, sqrt(sum(w * w)) AS size FROM pw GROUP BY 1),
hits AS (
  SELECT pw.p, pw.r, tw.template, tw.license, sum(pw.w * tw.w) AS dot FROM pw JOIN tw USING (template, term) GROUP BY ALL),
scores AS (
  SELECT r, license, dot / pl.size / tl.size AS score, dot / pl.size AS held FROM hits JOIN pl USING (p) JOIN tl USING (template)),
own AS (
  SELECT r, license AS own_license, round(score, 6) AS own_score FROM scores WHERE score >= {LEAST}
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY round(held, 9) DESC, license, score DESC) = 1),
listed AS (SELECT * FROM files LEFT JOIN own USING (r)),
granted AS (
  SELECT dir, own_license FROM listed WHERE whole AND own_license IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_score DESC, path, own_license) = 1)
SELECT l.doc_id, l.path, l.own_license, l.own_score, coalesce(f.own_license, p.own_license) AS inherited_license,
       coalesce(f.dir, p.dir) AS inherited_from, coalesce(l.own_license, f.own_license, p.own_license) AS license
FROM listed l LEFT JOIN granted f ON f.dir = l.dir LEFT JOIN granted p ON p.dir = l.package AND p.dir <> l.dir
""",
    "op7_vector_links": """
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT vec_id, b FROM reach JOIN links ON r = a),
least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM least
""",
    "op11_infill": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS d FROM documents),
h AS (
  SELECT doc_id, text, length(text) AS n, ('0x' || substr(d, 1, 8))::BIGINT % (length(text) + 1) AS p,
         ('0x' || substr(d, 9, 8))::BIGINT % (length(text) + 1) AS q, ('0x' || substr(d, 17, 8))::BIGINT % 100 AS r,
         ('0x' || substr(d, 25, 8))::BIGINT % 100 AS s FROM t),
f AS (
  SELECT doc_id, text, n, least(p, q) AS a, greatest(p, q) - least(p, q) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r >= 90 THEN 'plain'
              WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (
  SELECT *, '<P>' || substr(text, 1, a) AS prefix, '<M>' || substr(text, a + 1, b) AS middle, '<S>' || substr(text, a + b + 1) AS suffix
  FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN prefix || suffix || middle ELSE suffix || prefix || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM o
""",
    "op12_inner_search": """
WITH s AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
  FROM s q JOIN s x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id AND len(x.v) = len(q.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 10
""",
    "op13_lexical_search": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')) AS term
  FROM documents),
q AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')) AS term
  FROM benchmark),
c AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT r, count(*) AS n FROM d GROUP BY 1),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM c, s WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
m AS (SELECT r, 50 + (50 * n * docs) // total AS m FROM n, s),
p AS (
  SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM c JOIN m USING (r) JOIN w USING (term) JOIN q USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM p WHERE score > 0 QUALIFY rank <= 50
""",
}
