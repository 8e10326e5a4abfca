"""DuckDB SQL for the queries of this subpackage that SQL can express. The others depend on trained scores,
tokenizers, drawn numbers or hash functions that SQL lacks; their tests hold them against brute force."""

#: Plain windows of words, compared as text.
SUBSTRING = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
firsts AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN firsts USING (h), (SELECT unnest(range(50)) AS k) WHERE low < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS rest, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

#: All pairs that share a shingle, and the closure of the links.
NEARDUP = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, ways.b FROM reached r JOIN ways ON r.b = ways.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
FROM (SELECT a AS doc_id, min(b) AS least_id FROM reached GROUP BY 1) LEFT JOIN sizes USING (doc_id)"""

#: All pairs that share a shingle of three words, and the closure of the links.
JACCARD = NEARDUP.replace("i + 4", "i + 2").replace("len(ws) - 3", "len(ws) - 1").replace(">= 85", ">= 90").replace(", doc_id = least_id AS kept", "")

_PART = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')"
_LEAF = lambda text: f"sha256({' || '.join(map(_PART, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
#: crc32, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""

#: Both trees level by level, then every leaf's way up.
MANIFEST = f"""
WITH RECURSIVE leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {_LEAF("text")} AS leaf,
    CASE WHEN {_CRC} % 5 = 0 THEN {_LEAF("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_LEAF("text")} END AS used FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
low(tree, level, pos, h, m) AS (SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL SELECT tree, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(m) + 15) // 16 FROM low WHERE m > 1 GROUP BY tree, level, pos // 16),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low WHERE m = 1),
high(level, pos, h, m) AS (SELECT 0, pos, h, count(*) OVER () FROM subs
  UNION ALL SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(m) + 15) // 16 FROM high WHERE m > 1 GROUP BY level, pos // 16),
nodes AS (SELECT 1 AS k, * FROM low UNION ALL SELECT 2, '', * FROM high),
steps AS (SELECT k, tree, level, pos, m,
    coalesce(string_agg(h, '') OVER (PARTITION BY k, tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY k, tree, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM nodes),
way(id, own, k, tree, level, pos, h, proof, home) AS (SELECT doc_id, pos, 1, tree, 0, pos, used, '', tree FROM placed
  UNION ALL SELECT w.id, w.own, CASE WHEN s.m > 1 THEN w.k ELSE 2 END, CASE WHEN s.m > 1 THEN w.tree ELSE '' END, CASE WHEN s.m > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN s.m > 1 THEN w.pos // 16 ELSE u.pos END,
    CASE WHEN s.m > 1 THEN sha256(s.l || w.h || s.r) ELSE w.h END, CASE WHEN s.m > 1 THEN w.proof || s.l || s.r ELSE w.proof END, w.home
  FROM way w JOIN steps s ON s.k = w.k AND s.tree = w.tree AND s.level = w.level AND s.pos = w.pos LEFT JOIN subs u ON u.tree = w.tree AND w.k = 1 WHERE s.m > 1 OR w.k = 1),
ends AS (SELECT w.* FROM way w JOIN nodes n ON n.k = 2 AND w.k = 2 AND n.level = w.level AND n.pos = w.pos WHERE n.m = 1)
SELECT p.doc_id, p.leaf, u.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM placed p JOIN ends e ON e.home = p.tree AND e.own = p.pos JOIN subs u ON u.tree = p.tree, (SELECT h FROM high WHERE m = 1) t"""

ORACLE_SQL: dict[str, str] = {"op1_substring": SUBSTRING, "op9_neardup": NEARDUP, "op11_manifest": MANIFEST, "op12_jaccard": JACCARD}
