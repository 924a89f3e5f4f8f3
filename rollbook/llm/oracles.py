"""DuckDB statements for the queries that SQL can express.

The others draw by hashes that SQL lacks, or are learned; tests hold them
against brute force.
"""

from __future__ import annotations

import string

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase

#: Smallest id reachable over links (a, b) in both directions, for all rows of nodes (id).
_REACHED = """
    reached AS /*recursive*/ (SELECT id, id AS seen FROM nodes
                UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.seen),
    roots AS (SELECT id, min(seen) AS component_id FROM reached GROUP BY id)
"""

_NEAR_TEXTS = f"""
    WITH RECURSIVE words AS (
      SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    nodes AS (SELECT id FROM words),
    sets AS (
      SELECT DISTINCT id, unnest([array_to_string(w[i : i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))]) AS s
      FROM words WHERE len(w) > 0),
    sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
    shared AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM sets x JOIN sets y ON x.s = y.s AND x.id <> y.id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b
              WHERE 100 * k >= 75 * (p.n + q.n - k)),
    {_REACHED}
    SELECT roots.id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, roots.id = component_id AS kept
    FROM roots LEFT JOIN sizes ON sizes.id = roots.id
"""

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0"

_TOP_K = f"""
    WITH scaled AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, [floor(256 * cast(x AS double)) for x in embedding] AS z
                    FROM embeddings WHERE {_FINITE}),
    scores AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, cast(list_dot_product(q.z, c.z) AS bigint) AS score
               FROM scaled q, scaled c WHERE q.vec_id % 50 = 0 AND c.row <> q.row AND len(c.z) = len(q.z)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM scores)
    SELECT query_id, cast(rank AS int) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_NEAR_VECTORS = f"""
    WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
    sound AS (SELECT vec_id AS id, cast(embedding AS double[]) AS v FROM embeddings
              WHERE {_FINITE} AND len([x for x in embedding if x <> 0]) > 0),
    links AS (SELECT x.id AS a, y.id AS b FROM sound x, sound y
              WHERE x.id <> y.id AND list_cosine_similarity(x.v, y.v) >= 0.95),
    {_REACHED}
    SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept
    FROM roots
"""

# CRC-32 of the decimal id, bit by bit: a byte, then eight shifts
_CRC32 = """
    xor(4294967295::BIGINT, list_reduce(
      [4294967295::BIGINT] || flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')]),
      lambda r, s: CASE WHEN s >= 0 THEN xor(r, s) ELSE xor(r >> 1, 3988292384::BIGINT * (r & 1)) END))
"""

# Pairs of equal words of a document, q apart, in stretches of places that follow one another.
_RUNS = f"""
    WITH given AS (
      SELECT doc_id, {_CRC32} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sized AS (SELECT doc_id, h, h // 10 AS g, w, len(w) AS n FROM given),
    placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
    periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
    words AS (
      SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE [w[1 + if(i < a, i, a + (i - a) % p)] for i in range(n)] END AS w FROM periods),
    each AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM words),
    pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM each x JOIN each y
              ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
    islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
    stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches
             WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
    listed AS (
      SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
      FROM runs GROUP BY doc_id),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS place FROM runs),
    dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
      sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM words LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
    LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (doc_id)
"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_RANKED = f"""
    WITH docs AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
    sizes AS (SELECT doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
    totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM docs) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
                FROM counts, totals GROUP BY term),
    asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
    lengths AS (SELECT doc_id, 25 + (75 * n * n_docs) // n_terms AS m FROM sizes, totals),
    scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
               FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def statements() -> dict[str, str]:
    return {"op4_near_duplicates": _NEAR_TEXTS, "op7_top_k": _TOP_K, "op8_near_vectors": _NEAR_VECTORS, "op11_periodic_runs": _RUNS, "op12_ranked_search": _RANKED}
