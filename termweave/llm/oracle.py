"""DuckDB SQL for the queries of this subpackage that SQL can express."""

# crc32 of a decimal number's digits: eight shifts a byte over the reversed polynomial.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}::VARCHAR) + 1), lambda i: ascii(substr({0}::VARCHAR, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                       lambda r, k: xor(r >> 1, (r & 1) * 3988292384::BIGINT))))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels over ``leaves`` (tree, idx, n, digest), and each one's siblings."""
    return f"""{name} AS (
    SELECT tree, 0 AS level, idx, n, digest FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3, n),
{name}_sib AS (
    SELECT a.tree, a.level, a.idx,
           coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
           coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
    FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
    WHERE a.n > 1 GROUP BY ALL)"""


MERKLE_SQL = f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, source, {_leaf('text')} AS digest,
           CASE WHEN {_CRC32.format('doc_id')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS tampered
    FROM documents),
sources AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, count(*) AS n FROM rows GROUP BY source),
leaves AS (
    SELECT doc_id, tree, n, digest, tampered,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx
    FROM rows JOIN sources ON rows.source IS NOT DISTINCT FROM sources.source),
{_tree('low', 'leaves')},
subroots AS (SELECT 0 AS tree, tree AS idx, (SELECT count(*) FROM sources) AS n, digest FROM low WHERE n = 1),
{_tree('up', 'subroots')},
climb AS (
    SELECT doc_id, tree AS leaf_tree, idx AS leaf_idx, digest AS leaf, 0 AS part, tree, 0 AS level, idx,
           coalesce(tampered, digest) AS folded, '' AS proof, false AS done FROM leaves
    UNION ALL
    SELECT doc_id, leaf_tree, leaf_idx, leaf,
           CASE WHEN c.part = 0 AND s.tree IS NULL THEN 1 ELSE c.part END,
           CASE WHEN c.part = 0 AND s.tree IS NULL THEN 0 ELSE c.tree END,
           CASE WHEN c.part = 0 AND s.tree IS NULL THEN 0 WHEN coalesce(s.tree, u.tree) IS NULL THEN c.level ELSE c.level + 1 END,
           CASE WHEN c.part = 0 AND s.tree IS NULL THEN c.tree ELSE c.idx // 3 END,
           CASE WHEN coalesce(s.tree, u.tree) IS NULL THEN c.folded
                ELSE sha256(coalesce(s.l, u.l) || c.folded || coalesce(s.r, u.r)) END,
           c.proof || coalesce(s.l, u.l, '') || coalesce(s.r, u.r, ''),
           c.part = 1 AND u.tree IS NULL
    FROM climb c
    LEFT JOIN low_sib s ON c.part = 0 AND s.tree = c.tree AND s.level = c.level AND s.idx = c.idx
    LEFT JOIN up_sib u ON c.part = 1 AND u.tree = c.tree AND u.level = c.level AND u.idx = c.idx
    WHERE NOT c.done)
SELECT doc_id, leaf, sub.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = top.digest AS verified
FROM climb JOIN low sub ON sub.tree = climb.leaf_tree AND sub.n = 1 CROSS JOIN (SELECT digest FROM up WHERE n = 1) top
WHERE done"""


def _components(nodes: str, links: str) -> str:
    """part(id, root): the smallest id that links (a, b) lead to, for every id of ``nodes``."""
    return f"""reach AS (
    SELECT id, id AS other FROM {nodes}
    UNION
    SELECT r.id, l.b FROM reach r JOIN (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}) l ON r.other = l.a),
part AS (SELECT id, min(other) AS root FROM reach GROUP BY id)"""


# Cosines of all pairs, in double precision.
VECTOR_SQL = f"""
WITH RECURSIVE rows AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
    SELECT *, sqrt(list_dot_product(v, v)) AS length FROM rows
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y
    ON x.id < y.id AND len(x.v) = len(y.v) AND list_dot_product(x.v, y.v) / (x.length * y.length) >= 0.9),
{_components('rows', 'links')}
SELECT r.id AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, p.root AS component_id, p.root = r.id AS kept
FROM rows r JOIN part p ON p.id = r.id
LEFT JOIN (SELECT a, count(*) AS n FROM (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) GROUP BY a) n ON n.a = r.id"""

# Shingles of four words; every pair that shares one is held against 80 percent.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE_SQL = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
    GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
ids AS (SELECT doc_id AS id FROM documents),
{_components('ids', 'links')}
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, p.root AS component_id, p.root = d.doc_id AS kept
FROM documents d JOIN part p ON p.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

# Of equal payloads of 1000 bytes and more, the page with the largest id is the response.
ARCHIVE_SQL = """
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN strlen(body) >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 1000 AND page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)"""
