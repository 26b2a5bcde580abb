"""DuckDB SQL for sharding and the conversation queries, assembled from small expressions."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text: the bit-by-bit definition, folded over the text's bytes and seven empty steps after each."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda k: [ascii(({text})[k])::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    fold = f"list_reduce(list_prepend(4294967295::UBIGINT, {steps}), lambda c, e: xor(xor(c, e) >> 1, 3988292384::UBIGINT * (xor(c, e) & 1)))"
    return f"xor({fold}, 4294967295::UBIGINT)"


def crc32_of_bytes(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes: one table step a byte; ``crc_table`` is a list of 256 numbers, ``t`` its row."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::UBIGINT)"
    fold = f"list_reduce(list_prepend(4294967295::UBIGINT, {octets}), lambda c, b: xor(c >> 8, list_extract(crc_table, ((xor(c, b) & 255) + 1)::BIGINT)))"
    return f"xor({fold}, 4294967295::UBIGINT)::BIGINT"


CRC_TABLE = """
    crc AS (SELECT list_transform(range(256), lambda k: list_reduce([k::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, e: xor(c >> 1, 3988292384::UBIGINT * (c & 1)))) AS crc_table)
"""


TRIE = f"""
    WITH own AS (
      SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) AS t
      FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
    head AS (SELECT conv_id, t, conv_id - conv_id % 100 AS base, ({crc32('conv_id::VARCHAR')} % 6)::BIGINT AS h FROM own),
    whole AS (SELECT a.conv_id, coalesce(b.t[1:a.h], []) || a.t[a.h + 1:] AS t FROM head a LEFT JOIN own b ON b.conv_id = a.base),
    m AS (SELECT conv_id, d, t[1:d] AS p, d = len(t) AS ends FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM whole)),
    n AS (SELECT p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN length(p[d].x) ELSE 0 END AS len,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY p, d),
    k AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (p)),
    up AS (SELECT p[1:a] AS p, sum((n_convs - 1) * len)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
           FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM f) GROUP BY 1)
    SELECT f.conv_id, f.depth, g.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
    FROM f JOIN up USING (p) LEFT JOIN f g ON f.depth > 0 AND g.depth = f.depth - 1 AND g.p = f.p[1:f.depth - 1]
"""


def _then(state: str, cost: str, edit: str, line: str | None = None) -> str:
    """The state's best way with one more edit, and the repaired text with one more line."""
    text = f"{state}.o" if line is None else f"{state}.o || CASE WHEN {state}.o = '' THEN '' ELSE chr(10) END || {line}"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {text}}}"


NEVER = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"


def _best(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _shifted(state: str, initial: str, role: str | None) -> str:
    """The current row kept, or given a role, after ``state``."""
    keep = f"CASE WHEN fault NOT IN ('b', 'd') AND initial = '{initial}' THEN {_then(state, 'extra', 'K', 'line')} ELSE {NEVER} END"
    if role is None:
        return keep
    return f"{keep}, CASE WHEN fault NOT IN ('b', 'd') THEN {_then(state, '1 + extra', 'R', chr(39) + role + ':' + chr(39) + ' || text')} ELSE {NEVER} END"


def _inserted(state: str, role: str) -> str:
    return _then(state, "5", "I", f"'{role}:'")


# The ways to have read a row so far: nothing kept (n), a system turn last (s), a user turn last (u), an assistant turn last (a).
REPAIR = f"""
    WITH RECURSIVE given AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32('name')} % 20 AS kind FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations)),
    damaged AS (
      SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM given WHERE kind <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(coalesce(conv_id::VARCHAR, '-') || chr(0) || role || chr(0) || text)) AS i,
        regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS sign FROM damaged),
    turns AS (
      SELECT *, left(role, 1) AS initial, role || ':' || text AS line, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS extra FROM (
        SELECT *, CASE WHEN sign = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                       WHEN sign NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM placed)),
    counts AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
      FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM turns) GROUP BY conv_id),
    step AS (
      SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS n, {NEVER} AS s, {{'c': 5::BIGINT, 'a': 'I', 'o': 'user:'}} AS u,
        {{'c': 10::BIGINT, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:'}} AS a FROM counts
      UNION ALL
      SELECT conv_id, i, n, s, u, {_best('a', _inserted('u', 'assistant'))} AS a FROM (
        SELECT conv_id, i, n, s, {_best('u', _inserted('n', 'user'), _inserted('s', 'user'), _inserted('a', 'user'))} AS u, a FROM (
          SELECT step.conv_id, turns.i, {_then('n', '2', 'D')} AS n, {_best(_then('s', '2', 'D'), _shifted('n', 's', None))} AS s,
            {_best(_then('u', '2', 'D'), *(_shifted(x, 'u', 'user') for x in 'nsa'))} AS u,
            {_best(_then('a', '2', 'D'), _shifted('u', 'a', 'assistant'))} AS a
          FROM step JOIN turns ON turns.conv_id IS NOT DISTINCT FROM step.conv_id AND turns.i = step.i + 1))),
    done AS (SELECT step.conv_id, {_best('step.n', 'a')} AS best FROM step JOIN counts k ON k.conv_id IS NOT DISTINCT FROM step.conv_id WHERE i = k.n)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.o, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id
"""


#: The shards follow from one order of all rows; splitters and ranges only find them without that order.
SHARDS = f"""
    WITH {CRC_TABLE},
    d AS (SELECT doc_id, coalesce(text, '') AS x, strlen(coalesce(text, '')) + 1 AS size, md5(coalesce(text, '')) AS g FROM documents),
    t AS (SELECT sum(size)::BIGINT AS total, max(size) AS largest FROM d),
    o AS (SELECT *, sum(size) OVER (ORDER BY g, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)::BIGINT AS upto, sum(size) OVER (PARTITION BY g)::BIGINT AS group_size FROM d),
    m AS (SELECT *, CASE WHEN group_size > largest THEN 2 * upto - size ELSE 2 * max(upto) OVER (PARTITION BY g) - group_size END AS middle FROM o, t),
    s AS (SELECT *, least(7, (middle * 8) // (2 * total))::INTEGER AS shard FROM m)
    SELECT doc_id, size::BIGINT AS size, {crc32_of_bytes('x')} AS text_crc32, 'bytes' AS law, shard,
      row_number() OVER (PARTITION BY shard ORDER BY g, doc_id NULLS FIRST) - 1 AS slot, NULL::INTEGER AS grown_shard FROM s, crc
"""
