"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from cartwheel.llm.chat_format import CONTROL, END, START
from cartwheel.llm.common import A_TO_Z_LOWER, A_TO_Z_UPPER
from cartwheel.llm.pfair_mix import OTHER
from cartwheel.llm.queries import CONTROL_TEXT, MIX_BLOCK_ROWS, MIX_OTHER_SHARE, MIX_SHARES


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP4 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              '{A_TO_Z_UPPER}', '{A_TO_Z_LOWER}') AS key FROM lines),
bad AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, key IN (SELECT key FROM bad) AS dropped FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_SHARES = " UNION ALL ".join(f"SELECT {_text(c)} AS cls, {n} AS n" for c, n in {**MIX_SHARES, OTHER: MIX_OTHER_SHARE}.items())
_NAMED = ", ".join(_text(c) for c in MIX_SHARES)

OP5 = f"""
WITH RECURSIVE shares AS ({_SHARES}),
d AS (SELECT doc_id, source, CASE WHEN source IN ({_NAMED}) THEN source ELSE {_text(OTHER)} END AS cls,
             ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS k FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY k, doc_id) - 1 AS rk FROM d),
start AS (SELECT list({{'c': cls, 'n': n, 'l': b, 'k': 0::BIGINT}} ORDER BY cls) AS st FROM (
    SELECT cls, any_value(n)::BIGINT AS n, ((count(*) + {MIX_BLOCK_ROWS - 1}) // {MIX_BLOCK_ROWS})::BIGINT AS b
    FROM d JOIN shares USING (cls) GROUP BY cls)),
sim AS (
    SELECT 0::BIGINT AS slot, 0::BIGINT AS t, 0 AS phase, st, NULL::VARCHAR AS pick, 0 AS pick_phase FROM start
    UNION ALL
    SELECT slot + 1, CASE WHEN ended THEN 0 ELSE t + 1 END, CASE WHEN ended THEN phase + 1 ELSE phase END,
           list_transform(st2, lambda x: {{'c': x.c, 'n': x.n, 'l': x.l, 'k': CASE WHEN ended THEN 0::BIGINT ELSE x.k END}}),
           p, phase
    FROM (SELECT *, list_transform(st, lambda x: CASE WHEN x.c = p THEN {{'c': x.c, 'n': x.n, 'l': x.l - 1, 'k': x.k + 1}}
                                           ELSE x END) AS st2,
                 len(list_filter(st, lambda x: x.c = p AND x.l = 1)) > 0 AS ended
          FROM (SELECT *, list_min(list_transform(
                       list_filter(st, lambda x: x.l > 0 AND (x.k * total) // x.n <= t),
                       lambda x: {{'d': ((x.k + 1) * total + x.n - 1) // x.n, 'c': x.c}})).c AS p
                FROM (SELECT *, list_sum(list_transform(list_filter(st, lambda x: x.l > 0), lambda x: x.n))::BIGINT AS total
                      FROM sim WHERE len(list_filter(st, lambda x: x.l > 0)) > 0)))
),
blocks AS (SELECT slot - 1 AS slot, pick AS cls, pick_phase AS phase,
                  row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS blk FROM sim WHERE pick IS NOT NULL),
sized AS (SELECT cls, rk // {MIX_BLOCK_ROWS} AS blk, count(*) AS m FROM ranked GROUP BY ALL),
placed AS (SELECT blocks.*, sum(m) OVER (ORDER BY slot) - m AS before FROM blocks JOIN sized USING (cls, blk))
SELECT doc_id, source, ranked.cls AS mix_class, phase AS mix_phase, slot AS mix_slot,
       (before + rk % {MIX_BLOCK_ROWS})::BIGINT AS mix_position
FROM ranked JOIN placed ON ranked.cls = placed.cls AND ranked.rk // {MIX_BLOCK_ROWS} = placed.blk
"""


def _count(col: str, s: str) -> str:
    return f"(length({col}) - length(replace({col}, {_text(s)}, ''))) // {len(s)}"


_TEXT_LEN = "length(text) + " + " + ".join(_count("text", s) for s in ["\\", *CONTROL])
_ROLE_LEN = f"length(role) + 2 * ({_count('role', '%')} + {_count('role', '<')} + length(role) - length(replace(role, chr(10), '')))"

OP8 = f"""
WITH log AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', {_text(CONTROL_TEXT)} UNION ALL SELECT -1, 1, 'assistant', {_text(CONTROL_TEXT)})
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(START) + len(END) + 2} + {_ROLE_LEN} + {_TEXT_LEN})::BIGINT AS formatted_chars
FROM log GROUP BY conv_id
"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{A_TO_Z_UPPER}', '{A_TO_Z_LOWER}'), " \
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
WITH items AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS size
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, s, size, item_id FROM grams JOIN windows USING (win, size)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
who AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN who USING (doc_id)
"""


def _crc32(s: str) -> str:
    """The unsigned CRC-32 (polynomial 0xEDB88320) of an ASCII string expression."""
    step = "list_reduce(list_concat([xor(c, b)], range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)), " \
        f"lambda c, b: {step}), 4294967295)"


OP11 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role, text) AS own,
             {_crc32("conv_id::VARCHAR")} % 4 AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS turns
      FROM c LEFT JOIN c AS b ON b.conv_id = c.conv_id - c.conv_id % 20),
m AS (SELECT conv_id, d, turns[1:d] AS node, d = len(turns) AS ends, turns[d].t AS last
      FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (SELECT node, d AS depth, min(conv_id) AS name, count(*) AS n_convs,
             CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(any_value(last), '[^\\x20\\x09-\\x0D]+')) END AS words,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
      FROM m GROUP BY node, d),
p AS (SELECT m.conv_id, m.d, n.name FROM m JOIN n ON m.d = n.depth AND m.node = n.node),
up AS (SELECT a.d AS depth, a.name, b.name AS parent FROM p AS a JOIN p AS b ON a.conv_id = b.conv_id AND b.d = a.d - 1
       WHERE a.conv_id = a.name),
kids AS (SELECT depth - 1 AS depth, parent AS name, count(*) AS k FROM up GROUP BY ALL),
full_nodes AS (SELECT n.*, up.parent, coalesce(kids.k, 0) AS k FROM n LEFT JOIN up USING (depth, name) LEFT JOIN kids USING (depth, name)),
below AS (SELECT DISTINCT a.d AS depth, a.name, b.d AS bd, b.name AS bn FROM p AS a JOIN p AS b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (SELECT below.depth, below.name, count(*) FILTER (f.k = 0) AS n_leaves, sum((f.n_convs - 1) * f.words)::BIGINT AS saved_tokens
         FROM below JOIN full_nodes AS f ON f.depth = below.bd AND f.name = below.bn GROUP BY ALL)
SELECT name AS conv_id, depth, parent AS parent_conv_id, n_convs, k AS n_children, n_leaves, saved_tokens, ends_sha256
FROM full_nodes JOIN sums USING (depth, name)
"""

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _after(cost: str, letter: str, state: str) -> str:
    """A suffix's weight with one more edit before it."""
    return f"{{'c': {cost} + {state}.c, 'a': '{letter}' || {state}.a}}"


def _row_step(q: str, keep: str, keep_to: str, rerole_to: str) -> str:
    """The lightest suffix from state ``q`` when the row comes next: delete, rerole or keep it."""
    never = "{'c': 1000000000, 'a': ''}"
    more = "(CASE WHEN f = 3 THEN 5 ELSE 0 END)"
    return f"list_min([{_after('2', 'D', q)}, CASE WHEN f IN (1, 2) THEN {never} ELSE {_after('1 + ' + more, 'R', rerole_to)} END, " \
        f"CASE WHEN f IN (1, 2) OR x <> '{keep}' THEN {never} ELSE {_after(more, 'K', keep_to)} END" + \
        (f", CASE WHEN f IN (1, 2) OR x <> 's' THEN {never} ELSE {_after(more, 'K', 's')} END])" if q == "e" else "])")


OP12 = f"""
WITH RECURSIVE src AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations),
hurt AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM src WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS x FROM hurt),
faulty AS (SELECT *, lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS px,
                  CASE WHEN trim(text, {_WS}) = '' THEN 1
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                       WHEN right(rtrim(text, {_WS}), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f FROM placed),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
                  count(*) FILTER (i > 1 AND px || x NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
-- suffix weights from the states empty, system, user, assistant, closed under insertions, from the last row on
sim AS (
    SELECT conv_id, n AS i, {{'c': 0::BIGINT, 'a': ''}} AS e, {{'c': 10::BIGINT, 'a': 'II'}} AS s,
           {{'c': 5::BIGINT, 'a': 'I'}} AS u, {{'c': 0::BIGINT, 'a': ''}} AS a FROM counts
    UNION ALL
    SELECT conv_id, i - 1, list_min([e1, {_after('5', 'I', 'u2')}]), list_min([s1, {_after('5', 'I', 'u2')}]), u2,
           list_min([a1, {_after('5', 'I', 'u1')}])
    FROM (SELECT *, list_min([u1, {_after('5', 'I', 'a1')}]) AS u2 FROM (
        SELECT sim.conv_id, sim.i, {_row_step('e', 'u', 'u', 'u')} AS e1, {_row_step('s', 'u', 'u', 'u')} AS s1,
               {_row_step('u', 'a', 'a', 'a')} AS u1, {_row_step('a', 'u', 'u', 'u')} AS a1
        FROM sim JOIN faulty ON sim.conv_id IS NOT DISTINCT FROM faulty.conv_id AND sim.i = faulty.i))
),
best AS (SELECT conv_id, e.c AS cost, e.a AS audit FROM sim WHERE i = 0),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS l, generate_subscripts(string_split(audit, ''), 1) AS p FROM best WHERE audit <> ''),
numbered AS (SELECT *, count(*) FILTER (l <> 'I') OVER w AS i, count(*) FILTER (l <> 'D') OVER w AS o
             FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
kept AS (SELECT numbered.*, faulty.role, faulty.text, faulty.x FROM numbered LEFT JOIN faulty
         ON numbered.conv_id IS NOT DISTINCT FROM faulty.conv_id AND numbered.i = faulty.i AND l <> 'I' WHERE l <> 'D'),
sys AS (SELECT *, max(CASE WHEN o = 1 AND l = 'K' AND x = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS has_s FROM kept),
texts AS (SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN (o - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                     || ':' || coalesce(text, ''), chr(10) ORDER BY o) AS body FROM sys GROUP BY conv_id)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS every
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM every.conv_id
"""

ORACLES = {"op6_decontaminate": OP6, "op4_line_dedup": OP4, "op5_mix_sources": OP5, "op8_chat_format": OP8,
           "op11_prefix_trie": OP11, "op12_turn_repair": OP12}
