"""SQL over whole tables for the queries that SQL can state; the tests compare the others with plain versions."""

WORDS = r"regexp_extract_all({text}, '[^ \t\n\x0B\f\r]+')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: Level k = 5 * 3**j finds the runs of periods above k / 3 and up to k; enough levels for a million words.
LEVELS = [5 * 3**j for j in range(11)]


def _gram_level(k: int) -> str:
    """The hash of each k words: of five words, or of three hashes of a level below."""
    if k == LEVELS[0]:
        return f"""g{k} AS MATERIALIZED (
    SELECT doc_id, i, n, sha256(word || ' ' || {" || ' ' || ".join(f"lead(word, {j}) OVER w" for j in range(1, k))}) AS g
    FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""
    third = k // 3
    parts = " || ".join(["g", f"lead(g, {third}) OVER w", f"lead(g, {2 * third}) OVER w"])
    return f"""g{k} AS MATERIALIZED (
    SELECT doc_id, i, n, sha256({parts}) AS g FROM g{third} WHERE n >= {4 * (third + 1)}
    WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


def _seeds(k: int) -> str:
    lag = "lead(i) OVER (PARTITION BY doc_id, g ORDER BY i) - i"
    return f"SELECT doc_id, i, {lag} AS q, {k} AS k FROM g{k} WHERE g IS NOT NULL QUALIFY q BETWEEN {k // 3 + 1 if k > 5 else 1} AND {k}"


PERIODIC_RUNS = f"""
WITH RECURSIVE bits AS (
    SELECT doc_id, 0 AS byte, CAST(doc_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS c FROM documents
    UNION ALL
    SELECT doc_id, byte + 1, s, list_reduce([xor(c, CAST(ascii(s[byte + 1]) AS BIGINT)), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) FROM bits WHERE byte < len(s)
),
hashes AS (SELECT doc_id, xor(c, 4294967295) AS h FROM bits WHERE byte = len(s)),
texts AS (
    SELECT doc_id, h, h // 10 AS g, {WORDS.format(text="coalesce(text, '')")} AS w, len(w) AS n
    FROM documents JOIN hashes USING (doc_id)
),
loops AS (SELECT doc_id, h % 10 = 0 AND n > 0 AS looped, w, n, g % greatest(n, 1) AS a, 1 + (n - a) // (3 + g % 8) AS p FROM texts),
words AS MATERIALIZED (
    SELECT doc_id, n, i, w[1 + CASE WHEN looped AND i >= a THEN a + (i - a) % p ELSE i END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM loops)
),
{", ".join(map(_gram_level, LEVELS))},
seeds AS ({" UNION ALL ".join(map(_seeds, LEVELS))}),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM seeds),
runs AS MATERIALIZED (
    SELECT doc_id, min(i) AS start, max(i) + any_value(k) + q - min(i) AS length, q AS period
    FROM islands GROUP BY doc_id, q, island HAVING length >= greatest(6, 4 * q)
),
shown AS (
    SELECT doc_id, count(*) AS n_runs, min(({{'l': -length, 's': start, 'q': period}})) AS best,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
),
covered AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text
    FROM words LEFT JOIN covered ON words.doc_id = covered.doc_id AND words.i = covered.i WHERE covered.i IS NULL GROUP BY words.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.q AS period,
    1000 * -best.l // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN shown ON shown.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

TERMS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL = {
    "op11_periodic_runs": PERIODIC_RUNS,
    "op12_lexical_search": f"""
WITH terms AS (SELECT doc_id, unnest({TERMS.format(text=LOWERED)}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
size AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, size GROUP BY term, n_docs
),
items AS (SELECT DISTINCT item_id, unnest({TERMS.format(text=LOWERED)}) AS term FROM benchmark),
scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), size GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
""",
    "op13_warc": """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, strlen(payload) AS bytes FROM pages),
latest AS (SELECT payload, max(page_id) AS owner FROM payloads WHERE bytes >= 1000 GROUP BY payload)
SELECT page_id, bytes AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM payloads LEFT JOIN latest USING (payload)
""",
    "op1_substring_dedup": f"""
WITH t AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM t),
windows AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 34], ' ')) AS h FROM starts),
again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM windows SEMI JOIN again USING (h)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t),
kept AS (
    SELECT words.doc_id, count(covered.i) AS n_removed,
        coalesce(string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE covered.i IS NULL), '') AS kept
    FROM words LEFT JOIN covered ON words.doc_id = covered.doc_id AND words.i = covered.i GROUP BY words.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
""",
    "op10_near_duplicates": f"""
WITH RECURSIVE t AS (SELECT doc_id, {WORDS.format(text=LOWERED)} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM t WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS g FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT common.a, common.b FROM common
    JOIN sizes x ON x.doc_id = common.a JOIN sizes y ON y.doc_id = common.b
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
),
reached(doc_id, node) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.node
),
least AS (SELECT doc_id, min(node) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
""",
}
