"""Equivalent SQL of the training-data queries, where SQL can express them."""

NOW = """
now AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY skill_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM skills WHERE skill_id IS NOT NULL
  ) WHERE rn = 1
)"""

P2 = f"""
WITH {NOW},
live AS (
  SELECT skill_id, coalesce(lower(trim(source)), '') AS src, updated_at,
         CASE WHEN NOT isnan(quality_score) AND quality_score BETWEEN 0 AND 1 THEN quality_score END AS score
  FROM now WHERE NOT deleted
),
ranked AS (
  SELECT skill_id, row_number() OVER (PARTITION BY src ORDER BY score DESC NULLS LAST, updated_at DESC NULLS LAST, skill_id) AS r FROM live
)
SELECT skill_id FROM ranked WHERE r > (SELECT count(*) * 3 // 100 FROM live)
"""

GROUPS = f"""
{NOW},
verdict AS (
  SELECT least(k[1:64], k[66:129]) AS ha, greatest(k[1:64], k[66:129]) AS hb, is_duplicate,
         try_cast(CASE WHEN regexp_matches(j, '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') THEN j ELSE j || '+00:00' END AS timestamptz) AS seen
  FROM (SELECT regexp_replace(lower(pair_key), '\\s+', '', 'g') AS k, is_duplicate, trim(judged_at) AS j FROM dedup_judgments)
  WHERE is_duplicate IS NOT NULL AND regexp_matches(k, '^[0-9a-f]{{64}}:[0-9a-f]{{64}}$')
),
agreed AS (
  SELECT ha, hb FROM (
    SELECT *, row_number() OVER (PARTITION BY ha, hb ORDER BY seen DESC NULLS LAST, is_duplicate DESC) AS rn FROM verdict
  ) WHERE rn = 1 AND is_duplicate = 1
),
star AS (SELECT content_hash, min(skill_id) AS rep FROM now WHERE content_hash IS NOT NULL GROUP BY content_hash),
link AS (
  SELECT skill_id AS a, rep AS b FROM now JOIN star USING (content_hash) WHERE skill_id <> rep
  UNION
  SELECT n.skill_id, t.skill_id FROM now n JOIN now t ON trim(n.superseded_by) = t.skill_id WHERE n.skill_id <> t.skill_id
  UNION
  SELECT x.rep, y.rep FROM agreed JOIN star x ON x.content_hash = ha JOIN star y ON y.content_hash = hb WHERE x.rep <> y.rep
),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
grp AS (SELECT a AS skill_id, least(a, min(b)) AS group_id FROM reach GROUP BY a)
"""

P5 = f"WITH RECURSIVE {GROUPS} SELECT skill_id, group_id FROM grp"

P4 = f"""
WITH RECURSIVE {GROUPS},
trust AS (SELECT lower(trim(source)) AS src, max(source_weight) AS trust FROM source_registry GROUP BY 1),
member AS (
  SELECT g.group_id, n.skill_id, n.updated_at, trust,
         CASE WHEN NOT isnan(quality_score) AND quality_score BETWEEN 0 AND 1 THEN quality_score END AS score,
         lower(trim(regexp_replace(license, '\\s+', ' ', 'g'))) AS lic
  FROM grp g JOIN now n USING (skill_id) LEFT JOIN trust ON src = lower(trim(n.source))
),
first_of AS (
  SELECT group_id, skill_id AS survivor_id FROM (
    SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC NULLS LAST, trust DESC NULLS LAST, updated_at DESC NULLS LAST, skill_id) AS rn FROM member
  ) WHERE rn = 1
),
lic_of AS (
  SELECT group_id, skill_id AS license_from FROM (
    SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY trust DESC NULLS LAST, score DESC NULLS LAST, updated_at DESC NULLS LAST, skill_id) AS rn
    FROM member WHERE lic IS NOT NULL
      AND lic NOT IN ('', '-', 'unknown', 'tbd', 'n/a', 'noassertion', 'see license file', 'license.txt')
  ) WHERE rn = 1
)
SELECT group_id, survivor_id, coalesce(license_from, '') AS license_from FROM first_of LEFT JOIN lic_of USING (group_id)
"""

_WORDS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"

P1 = f"""
WITH body AS (SELECT content_hash, any_value(body) AS body FROM skills WHERE content_hash IS NOT NULL AND body IS NOT NULL GROUP BY content_hash),
word AS (SELECT content_hash AS h, {_WORDS.format('body')} AS w FROM body),
gram AS (
  SELECT h, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) AS g FROM word WHERE len(w) >= 60
),
code AS (SELECT h, row_number() OVER (ORDER BY h) AS d, len(g) AS n, g FROM gram),
post AS (SELECT d, hash(unnest(g)) AS t FROM code),
rare AS (SELECT d, t FROM post WHERE t IN (SELECT t FROM post GROUP BY t HAVING count(*) > 1)),
cand AS (SELECT DISTINCT a.d AS a, b.d AS b FROM rare a JOIN rare b ON a.t = b.t AND a.d < b.d),
meet AS (
  SELECT x.h AS ha, y.h AS hb, x.n AS na, y.n AS nb, len(list_intersect(x.g, y.g)) AS s
  FROM cand JOIN code x ON x.d = a JOIN code y ON y.d = b
)
SELECT least(ha, hb) AS content_hash_a, greatest(ha, hb) AS content_hash_b FROM meet WHERE 2 * s >= na + nb - s
"""

P7 = f"""
WITH item AS (SELECT item_id, {_WORDS.format('text')} AS w FROM eval_items),
doc AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
ig AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i+11], ' '))) AS g FROM item WHERE len(w) >= 12),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i+11], ' '))) AS g FROM doc WHERE len(w) >= 12)
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)
"""

SQL = {"p1_found": P1, "p2_found": P2, "p4_found": P4, "p5_found": P5, "p7_found": P7}
