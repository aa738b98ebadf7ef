"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Repeating weights, budget and copies as in the contract; the level is where the sources that
# stop at twice their size (the smallest by size over weight) and the others share the budget. All
# coins of a source are turned by the 64th part of their range that brings it nearest to its target.
ORACLE["op9_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT AS coin
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM sources
), ordered AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM weighted
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - 2 * coalesce(sum(source_size) OVER (ORDER BY full_at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0))
      / sum(weight) OVER (ORDER BY full_at RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ordered
), reached AS (
  SELECT coalesce((SELECT level FROM levels WHERE level <= full_at ORDER BY full_at LIMIT 1), 0.0) AS level
), targets AS (
  SELECT w.source, w.source_size, least(2.0::DOUBLE * w.source_size, r.level * w.weight) AS target FROM weighted w, reached r
), rated AS (
  SELECT s.doc_id, s.source, s.size, s.coin, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    ceil((CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END
      - floor(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END)) * 4503599627370496.0::DOUBLE)::BIGINT AS lim
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), tried AS (
  SELECT source, turn, abs(sum(size * (floor(rate)::BIGINT + CASE WHEN (coin + turn * 70368744177664) % 4503599627370496 < lim THEN 1 ELSE 0 END))::DOUBLE
      - any_value(target)) AS off
  FROM rated, range(64) AS r(turn) GROUP BY source, turn
), seeds AS (
  SELECT source, arg_min(turn, (off, turn)) AS turn FROM tried GROUP BY source
)
SELECT r.doc_id, r.size::BIGINT AS size, r.source_size, r.target,
  (r.size * (floor(r.rate) + CASE WHEN (r.coin + s.turn * 70368744177664) % 4503599627370496 < r.lim THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated r JOIN seeds s ON r.source IS NOT DISTINCT FROM s.source
"""

# All pairs, and everything that links reach. Vectors of the table are never null, empty or zero
# and have one length, which the SQL relies on.
ORACLE["op1_embedding_near_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS x FROM embeddings
), links AS (
  SELECT a.row AS a, b.row AS b FROM vectors a JOIN vectors b ON a.row <> b.row WHERE list_cosine_similarity(a.x, b.x) >= 0.95
), reach AS (
  SELECT row AS a, row AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a AS row, min(vec_id) AS component_id FROM reach JOIN vectors ON vectors.row = b GROUP BY 1
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = v.row) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors v JOIN least USING (row)
"""

# The turns of the table are plain text, so each request of a user is a call of ``reply``.
ORACLE["op7_tool_call_linking"] = """
WITH calls AS (
  SELECT conv_id, conv_id || ':' || turn AS call_id, turn, text,
    CASE WHEN turn >= 2 THEN '{"after":{"$ref":"' || conv_id || ':' || (turn - 2) || '"},' ELSE '{' END
      || '"prompt":' || to_json(coalesce(text, ''))::VARCHAR || '}' AS arguments
  FROM conversations WHERE role = 'user'
), results AS (
  SELECT conv_id, conv_id || ':' || (turn - 1) AS call_id, turn, coalesce(text, '') AS content FROM conversations WHERE role = 'assistant'
), first_calls AS (
  SELECT conv_id, call_id, min(turn) AS call_turn, arg_min(arguments, (turn, arguments)) AS arguments, count(*) AS n_calls FROM calls GROUP BY 1, 2
), first_results AS (
  SELECT conv_id, call_id, min(turn) AS result_turn, arg_min(content, (turn, content)) AS content, count(*) AS n_results FROM results GROUP BY 1, 2
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, false AS repeat, call_turn,
  CASE WHEN n_calls > 0 THEN 0::BIGINT END AS call_index, result_turn, CASE WHEN n_calls > 0 THEN 'reply' END AS name,
  call_turn AS lift_turn, CASE WHEN n_calls > 0 THEN 0::BIGINT END AS lift_index, CASE WHEN n_calls > 0 THEN 0 END AS step, false AS cyclic,
  coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
  CASE WHEN n_calls > 0 THEN '' ELSE 'no call' END AS errors, coalesce(n_calls, 0) > 0 AS valid,
  '{"arguments":' || coalesce(arguments, 'null') || ',"id":"' || coalesce(c.call_id, r.call_id) || '","name":'
    || CASE WHEN n_calls > 0 THEN '"reply"' ELSE 'null' END || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json
FROM first_calls c FULL JOIN first_results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
UNION ALL
SELECT conv_id, call_id, true, turn, 0, NULL, 'reply', NULL, NULL, NULL, false, count(*) - any_value(own), 0, '', true,
  '{"arguments":' || arguments || ',"id":"' || call_id || '","name":"reply","result":null}'
FROM (SELECT *, (first_calls.call_turn = turn AND first_calls.arguments = calls.arguments)::BIGINT AS own
  FROM calls JOIN first_calls USING (conv_id, call_id) WHERE n_calls > 1) AS t(conv_id, call_id, turn, text, arguments, ct, fa, n, own)
GROUP BY conv_id, call_id, turn, arguments HAVING count(*) > any_value(own)
UNION ALL
SELECT conv_id, call_id, true, NULL, NULL, turn, NULL, NULL, NULL, NULL, false, 0, count(*) - any_value(own), 'no call', false,
  '{"arguments":null,"id":"' || call_id || '","name":null,"result":' || to_json(content)::VARCHAR || '}'
FROM (SELECT *, (first_results.result_turn = turn AND first_results.content = results.content)::BIGINT AS own
  FROM results JOIN first_results USING (conv_id, call_id) WHERE n_results > 1) AS t(conv_id, call_id, turn, content, rt, fc, n, own)
GROUP BY conv_id, call_id, turn, content HAVING count(*) > any_value(own)
"""

# CRC-32 of a decimal number, bit by bit: an entry from 0 up is the next byte, -1 a step by one bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END), 4294967295)"""

# A run of period q holds at least 16 words in a row that equal those q before them, so it is a
# stretch of places whose 16 words also stand q before. Of stretches with several periods only the
# smallest counts.
ORACLE["op11_periodic_runs"] = rf"""
WITH source_words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, {_CRC32.format("doc_id")} AS h
  FROM documents
), places AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a,
    1 + (len(words) - a) // (3 + (h // 10) % 8) AS p
  FROM source_words
), planted AS (
  SELECT row, doc_id, CASE WHEN a IS NULL THEN words
    ELSE list_transform(range(len(words)), lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS words
  FROM places
), windows AS (
  SELECT row, i, list_slice(words, i + 1, i + 16) AS w FROM planted, unnest(range(greatest(len(words) - 15, 0))) AS u(i)
), cells AS (
  SELECT x.row, x.i, x.i - y.i AS lag FROM windows x JOIN windows y ON x.row = y.row AND x.w = y.w AND x.i > y.i
), numbered AS (
  SELECT *, i - row_number() OVER (PARTITION BY row, lag ORDER BY i) AS stretch FROM cells
), stretches AS (
  SELECT row, lag, min(i) - lag AS start, max(i) + 16 AS stop FROM numbered GROUP BY row, lag, stretch
), long AS (
  SELECT * FROM stretches WHERE stop - start >= greatest(24, 3 * lag)
), runs AS (
  SELECT row, start, stop - start AS length, lag AS period FROM long
  WHERE NOT EXISTS (SELECT 1 FROM long s WHERE s.row = long.row AND s.lag < long.lag AND s.start <= long.start AND s.stop >= long.stop)
), listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY row
), best AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs b WHERE b.row = r.row AND (b.length * r.period > r.length * b.period
      OR b.length * r.period = r.length * b.period AND (b.start, b.period) < (r.start, r.period)))
), dropped AS (
  SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), gone AS (
  SELECT row, list(i) AS gone FROM dropped GROUP BY row
), kept AS (
  SELECT row, array_to_string(list_filter(words, lambda w, k: NOT list_contains(gone, k - 1)), ' ') AS text FROM planted JOIN gone USING (row)
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, array_to_string(d.words, ' '), '')) AS collapsed_sha256
FROM planted d LEFT JOIN listed l USING (row) LEFT JOIN best b USING (row) LEFT JOIN kept k USING (row)
"""


def _tree(name: str, start: str, levels: int) -> str:
    """All levels of the trees of ``start(tree, pos, d)``: ``{name}(tree, level, pos, d, nodes)``, ``nodes`` of the tree on the level."""
    parts = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS nodes FROM ({start}))"]
    for i in range(levels):
        parts.append(
            f"""{name}{i + 1} AS (SELECT tree, pos // 3 AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d, (nodes + 2) // 3 AS nodes
            FROM {name}{i} WHERE nodes > 1 GROUP BY tree, pos // 3, nodes)"""
        )
    listed = " UNION ALL ".join(f"SELECT {i} AS level, * FROM {name}{i}" for i in range(levels + 1))
    return ", ".join([*parts, f"{name} AS ({listed})"])


def _merkle(levels: int = 13, source_levels: int = 8) -> str:
    """The tree level by level, down to one node for up to 3 to the power of the levels."""
    value = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(value, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    side = lambda tree, pos, own, before: (
        f"(SELECT coalesce(string_agg(d, '' ORDER BY t.pos), '') FROM {tree} t WHERE t.tree = {own} AND t.level = s.level"
        f" AND t.pos // 3 = {pos} // 3 AND t.pos {'<' if before else '>'} {pos})"
    )
    steps = []
    for i in range(levels + source_levels):
        steps.append(
            f"f{i + 1} AS (SELECT f.row, CASE WHEN s.row IS NULL THEN f.d ELSE sha256(s.l || f.d || s.r) END AS d"
            f" FROM f{i} f LEFT JOIN steps s ON s.row = f.row AND s.step = {i})"
        )
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('s' || source, '') AS tree, {leaf("text")} AS leaf,
    CASE WHEN {_CRC32.format("doc_id")} % 2 = 0 AND text IS NOT NULL THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS now
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos FROM docs
), {_tree("a", "SELECT tree, pos, leaf AS d FROM placed", levels)}, subroots AS (
  SELECT tree, d, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM a WHERE nodes = 1
), {_tree("b", "SELECT '' AS tree, pos, d FROM subroots", source_levels)}, roots AS (
  SELECT d FROM b WHERE nodes = 1
), wide AS (
  SELECT p.row, a.level AS step, p.tree AS own, a.pos, a.level, false AS top FROM placed p JOIN a ON a.tree = p.tree AND a.nodes > 1 AND a.pos = p.pos // (3 ** a.level)::BIGINT
  UNION ALL
  SELECT p.row, {levels} + b.level, '', b.pos, b.level, true FROM placed p JOIN subroots r USING (tree) JOIN b ON b.nodes > 1 AND b.pos = r.pos // (3 ** b.level)::BIGINT
), steps AS (
  SELECT row, step, CASE WHEN top THEN {side("b", "s.pos", "''", True)} ELSE {side("a", "s.pos", "s.own", True)} END AS l,
    CASE WHEN top THEN {side("b", "s.pos", "''", False)} ELSE {side("a", "s.pos", "s.own", False)} END AS r
  FROM wide s
), f0 AS (SELECT row, now AS d FROM docs), {", ".join(steps)}, proofs AS (
  SELECT row, string_agg(l || r, '' ORDER BY step) AS proof FROM steps GROUP BY row
)
SELECT doc_id, leaf, s.d AS subroot, roots.d AS root, sha256(coalesce(proof, '')) AS proof_sha256, f.d AS folded_root, f.d = roots.d AS verified
FROM docs JOIN subroots s USING (tree) CROSS JOIN roots JOIN f{levels + source_levels} f USING (row) LEFT JOIN proofs USING (row)
"""


ORACLE["op13_merkle_manifest"] = _merkle()
