"""SQL that states results of the registered queries of this subpackage, for DuckDB over the same tables."""

FILTER_AUDIT = r"""
WITH RECURSIVE read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM read
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), kinds AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, count(*) AS n,
    list_filter([
      CASE WHEN len(w) < 50 THEN 'A' END,
      CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN words.doc_id > first THEN 'E' END
    ], lambda x: x IS NOT NULL) AS fails
  FROM words LEFT JOIN marks ON words.doc_id = marks.doc_id
  GROUP BY ALL
), orders(o) AS (
  SELECT ''::VARCHAR
  UNION ALL
  SELECT o || x FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS letters(x) WHERE NOT contains(o, x)
), steps AS (
  SELECT o AS filter_order, s::INTEGER AS step, substr(o, s::INTEGER, 1) AS f, string_split(substr(o, 1, s::INTEGER), '') AS upto,
    list_filter(string_split(substr(o, 1, s::INTEGER - 1), ''), lambda x: x <> '') AS before
  FROM orders, range(1, 6) AS numbers(s) WHERE length(o) = 5
), outcomes AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT list_has_any(upto, fails) THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN list_contains(fails, f) AND NOT list_has_any(before, fails) THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN list_contains(fails, f) AND list_has_any(before, fails) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = [f] THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN good AND list_contains(fails, f) AND NOT list_has_any(before, fails) THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN toxic AND list_contains(fails, f) AND NOT list_has_any(before, fails) THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM kinds, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM outcomes
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Smallest node reachable: walks over links, which hold each pair in both directions.
REACH = """
reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE read AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT * FROM read WHERE label IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q
  ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.98
), {REACH}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
  vec_id <= coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id) AS kept
FROM read
"""

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, i, line, coalesce(doc_id <> last, FALSE) AS gone FROM keyed LEFT JOIN shared ON keyed.key = shared.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

PASSAGES = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts
), windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts WHERE len(w) >= 50)
), later AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY key) AS first FROM windows) WHERE doc_id > first
), covered AS (
  SELECT words.doc_id, n, word, words.i,
    coalesce(max(later.i) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS UNBOUNDED PRECEDING) > words.i - 50, FALSE) AS gone
  FROM words LEFT JOIN later ON words.doc_id = later.doc_id AND words.i = later.i
)
SELECT texts.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY doc_id
) AS cut ON texts.doc_id = cut.doc_id
"""

# Checksum of bytes as in zlib: a table of 256 remainders, then byte by byte.
CRC = """
remainders(i, step, r) AS (
  SELECT i, 0, i FROM range(256) AS numbers(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM remainders WHERE step < 8
), crc_table AS (
  SELECT list(r ORDER BY i) AS t FROM remainders WHERE step = 8
)"""


def _crc(text: str) -> str:
    """Checksum of the UTF-8 of a text, in a query that has ``crc_table`` beside."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"


SHARDING = f"""
WITH RECURSIVE {CRC}, sized AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(octet_length(encode(text)), 0) + 16 AS size FROM documents
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS total FROM sized
), sharded AS (
  SELECT *, CAST(((2 * upto - size) * 40) // (2 * total) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, {_crc("text")} AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM sharded, crc_table
"""

MINHASH_DEDUP = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
  FROM texts
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, p.n AS na, q.n AS nb, count(*) AS c
  FROM shingles p JOIN shingles q ON p.x = q.x AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n
), links AS (
  SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)
), {REACH}, least_reached AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept
FROM sets LEFT JOIN least_reached ON doc_id = a
"""


def _option(price: str, letter: str, after: str, line: str | None = None) -> str:
    lines = f"list_concat([{line}], {after}.l)" if line else f"{after}.l"
    return f"{{'c': {price} + {after}.c, 'w': '{letter}' || {after}.w, 'l': {lines}}}"


def _row_options(state: str, due: str, name: str, kept: dict[str, str]) -> str:
    """What a row can become in a state: deleted, given the role that is due, or kept if its initial may come there."""
    ways = [_option("4", "D", state), f"CASE WHEN NOT must THEN {_option('3 + more', 'R', due, f"'{name}:' || text")} END"]
    ways += [f"CASE WHEN NOT must AND x = '{x}' THEN {_option('more', 'K', to, 'line')} END" for x, to in kept.items()]
    return f"list_min(list_filter([{', '.join(ways)}], lambda o: o IS NOT NULL))"


def _or_insert(state: str, due: str, name: str) -> str:
    return f"list_min([{state}, {_option('3', 'I', due, f"'{name}:'")}])"


_END = "{{'c': {}::BIGINT, 'w': '{}', 'l': {}::VARCHAR[]}}"

# Suffix by suffix: cost, audit and lines of the cheapest edits from each state (none, s, u, a) on.
TURN_REPAIR = rf"""
WITH RECURSIVE {CRC}, struck AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how
  FROM conversations, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE how WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM struck)
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS x FROM damaged
), marked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open, lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x AS pair
  FROM turns
), rows AS (
  SELECT *, blank OR seen AS must, CASE WHEN open AND NOT blank AND NOT seen THEN 3 ELSE 0 END AS more, role || ':' || text AS line FROM marked
), faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE seen AND NOT blank) AS duplicate, count(*) FILTER (WHERE more > 0) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM rows GROUP BY conv_id
), best AS (
  SELECT conv_id, n + 1 AS i, {_END.format(0, "", "[]")} AS e, {_END.format(6, "II", "['user:', 'assistant:']")} AS s,
    {_END.format(3, "I", "['assistant:']")} AS u, {_END.format(0, "", "[]")} AS a
  FROM faults
  UNION ALL
  SELECT conv_id, i, {_or_insert("e1", "u", "user")}, {_or_insert("s1", "u", "user")}, u, a
  FROM (
    SELECT conv_id, i, e1, s1, {_or_insert("u1", "a1", "assistant")} AS u, {_or_insert("a1", "u1", "user")} AS a
    FROM (
      SELECT rows.conv_id, rows.i, {_row_options("e", "u", "user", {"s": "s", "u": "u"})} AS e1, {_row_options("s", "u", "user", {"u": "u"})} AS s1,
        {_row_options("u", "a", "assistant", {"a": "a"})} AS u1, {_row_options("a", "u", "user", {"u": "u"})} AS a1
      FROM best JOIN rows ON rows.conv_id IS NOT DISTINCT FROM best.conv_id AND rows.i = best.i - 1
    )
  )
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.w, '') AS audit, sha256(coalesce(array_to_string(e.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id AND best.i = 1
"""

SQL = {
    "op1_embedding_dedup": EMBEDDING_DEDUP,
    "op3_line_dedup": LINE_DEDUP,
    "op5_suffix_array_dedup": PASSAGES,
    "op8_sharding": SHARDING,
    "op9_minhash_dedup": MINHASH_DEDUP,
    "op10_substring_dedup": PASSAGES,
    "op11_filter_audit": FILTER_AUDIT,
    "op13_turn_repair": TURN_REPAIR,
}
