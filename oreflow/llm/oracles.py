"""SQL that must give the same rows as the queries."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string expression, bit by bit."""
    step = "lambda x, y: xor(x >> 1, (x & 1) * 3988292384)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), "
        f"lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), {step})), 4294967295::BIGINT)"
    )


def _leaf(n_chars: str = "n_chars") -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(" + " || ".join(f"COALESCE(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels over a relation (tree, place, digest)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, place, digest, COUNT(*) OVER (PARTITION BY tree) AS places FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(digest || COALESCE(beside, '')), (places + 1) // 2 FROM (
    SELECT *, LEAD(digest) OVER (PARTITION BY tree ORDER BY place) AS beside FROM {name} WHERE places > 1)
  WHERE place % 2 = 0)"""


def _path(leaves: str, nodes: str) -> str:
    """For each leaf its siblings: a letter for the side and the digest, from the leaf up."""
    return f"""SELECT l.tree, l.place, COALESCE(list(CASE WHEN (l.place >> n.level) % 2 = 1 THEN 'L' ELSE 'R' END || COALESCE(s.digest, '')
    ORDER BY n.level) FILTER (n.places > 1), []) AS path
  FROM {leaves} l JOIN {nodes} n ON n.tree = l.tree AND n.place = l.place >> n.level
  LEFT JOIN {nodes} s ON s.tree = n.tree AND s.level = n.level AND s.place = xor(n.place, 1) GROUP BY 1, 2"""


MANIFEST_SQL = f"""WITH RECURSIVE rows AS (SELECT doc_id, COALESCE('=' || lang, '') AS tree, {_leaf()} AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS tampered FROM documents),
placed AS (SELECT *, leaf AS digest, ROW_NUMBER() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM rows),
{_tree("nodes", "placed")},
subroots AS (SELECT '' AS tree, tree AS member, digest, ROW_NUMBER() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE places = 1),
{_tree("upper", "subroots")},
low AS ({_path("placed", "nodes")}),
high AS ({_path("subroots", "upper")}),
proofs AS (SELECT p.doc_id, p.leaf, p.tampered, s.digest AS subroot, (SELECT digest FROM upper WHERE places = 1) AS root,
    list_concat(low.path, high.path) AS path
  FROM placed p JOIN low USING (tree, place) JOIN subroots s ON s.member = p.tree JOIN high ON high.place = s.place),
folded AS (SELECT *, list_reduce(list_prepend(COALESCE(tampered, leaf), path), lambda h, s:
    sha256(CASE WHEN s[1] = 'L' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified FROM folded"""


_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES_SQL = rf"""WITH pieces AS (SELECT COALESCE(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM words GROUP BY 1),
sizes AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
spans AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM words, sizes WHERE len(w) >= k),
counts AS (SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase, COUNT(*) AS f FROM spans GROUP BY ALL HAVING COUNT(*) >= 100),
cuts AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM counts WHERE k > 1),
scored AS (SELECT c.lang, c.k, c.phrase, c.f AS a, l.f AS l, r.f AS r, n, cut,
    CAST(1000::HUGEINT * c.f * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(w[1 : cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(w[cut + 1 :], ' ')),
lowest AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (SELECT lang, f, w, k, unnest(range(2, k)) AS size FROM (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 2)),
held AS (SELECT lang, f, w, size, unnest(range(1, k - size + 2)) AS s FROM parts),
inner_phrases AS (SELECT lang, array_to_string(w[s : s + size - 1], ' ') AS phrase, MAX(f) AS most FROM held GROUP BY ALL),
kept AS (SELECT l.* FROM lowest l LEFT JOIN inner_phrases USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""


_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

# Shingles joined with each other, links closed transitively.
NEAR_SQL = rf"""WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda s: array_to_string(w[s : s + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT doc_id, COALESCE(ANY_VALUE(n), 0)::BIGINT AS n_shingles, MIN(other) AS component_id FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY 1"""

# Lines joined on the words of their prefixes, the rarest first by exact counts.
LINES_SQL = r"""WITH lines AS (SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS number, unnest(string_split(text, chr(10))) AS line FROM documents),
sets AS (SELECT doc_id, number, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS s FROM lines),
firsts AS (SELECT s, MIN((doc_id, number)) AS place, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
entries AS (SELECT place, n, unnest(s) AS word FROM firsts),
counts AS (SELECT word, COUNT(*) AS c FROM entries GROUP BY 1),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY place ORDER BY c, word) AS pos FROM entries JOIN counts USING (word)),
prefix AS (SELECT * FROM ranked WHERE pos <= n - (80 * n + 99) // 100 + 1),
pairs AS (SELECT DISTINCT x.place AS a, y.place AS b FROM prefix x JOIN prefix y ON x.word = y.word AND x.place < y.place
  AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
near AS (SELECT DISTINCT b AS place FROM pairs JOIN firsts x ON x.place = a JOIN firsts y ON y.place = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))),
removed AS (SELECT doc_id, number FROM sets JOIN firsts f USING (s) LEFT JOIN near ON near.place = f.place
  WHERE near.place IS NOT NULL OR (doc_id, number) <> f.place),
marked AS (SELECT l.*, r.number IS NOT NULL AS gone FROM lines l LEFT JOIN removed r ON r.doc_id = l.doc_id AND r.number = l.number),
done AS (SELECT doc_id, COUNT(*)::INT AS n_lines, SUM(gone::INT)::INT AS n_removed,
  COALESCE(string_agg(number::VARCHAR, ',' ORDER BY number) FILTER (gone), '') AS removed_lines,
  COALESCE(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '') AS kept FROM marked GROUP BY 1)
SELECT doc_id, n_lines, n_removed, removed_lines, sha256(kept) AS kept_sha256 FROM done
UNION ALL SELECT doc_id, 0, 0, '', NULL FROM documents WHERE text IS NULL"""

# Equal payloads by their digests; the address's host backwards.
ARCHIVE_SQL = r"""WITH own AS (SELECT page_id, COALESCE(html, '') AS body, regexp_replace(COALESCE(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
hashed AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
  regexp_replace(rest, '^[^/?#]*', '') AS path FROM own),
latest AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload_digest) AS last FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to,
  array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path AS url_key FROM latest"""
