"""DuckDB SQL of the queries that it can express on whole tables."""

from __future__ import annotations

import hashlib

from footfall.llm.chat import MAPPINGS, _nested
from footfall.llm.parity import PERCENT, WORDS
from footfall.llm.wumanber import SIZE

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NON_SPACE = r"[^\x20\x09-\x0D]+"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f'coalesce({text}, chr(32))')}, '{pattern}')"


def decontamination() -> str:
    return f"""
WITH docs AS (SELECT doc_id, {_words('text', _ALNUM)} AS w FROM documents),
items AS (SELECT item_id, {_words('text', _ALNUM)} AS w FROM benchmark),
windows AS (
  SELECT item_id, k, w[k:k + least({SIZE}, len(w)) - 1] AS win
  FROM (SELECT *, unnest(range(1, len(w) - least({SIZE}, len(w)) + 2)) AS k FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (
  SELECT doc_id, n, k, w[k:k + n - 1] AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM docs JOIN sizes ON len(w) >= n)
),
found AS (SELECT p.doc_id, p.k, p.n, b.item_id FROM places p JOIN windows b USING (win)),
hits AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) FROM found) GROUP BY 1),
owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::varchar AS item FROM found) GROUP BY 1
)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
  coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""


def ngram_join() -> str:
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words('text', _NON_SPACE)} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, w[k:k + {WORDS} - 1] AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WORDS} + 1, 1) + 1)) AS k FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM docs
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT doc_id, coalesce(any_value(n), 0)::bigint AS n_shingles, min(y) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.x = doc_id GROUP BY doc_id
"""


def chat() -> str:
    hashes = " ".join(
        f"WHEN '{name}' THEN '{hashlib.sha256(_nested(m.paths).encode()).hexdigest()}'" for name, m in MAPPINGS.items()
    )
    escaped = "replace(replace(replace({}, chr(92), chr(92) || 'b'), '<', chr(92) || 'l'), '#', chr(92) || 'h')"
    return f"""
WITH said AS (SELECT chr(92) || '### Assistant: </turn> ok' AS text),
rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', text FROM said UNION ALL SELECT -7, 1, 'assistant', text FROM said
),
convs AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length({escaped.format("role")}) + length({escaped.format("text")}) + length('### : </turn>') + 1
      + length(role) - length(replace(role, ':', ''))) AS formatted_chars,
    list(role ORDER BY turn, role, text) AS roles, list(text ORDER BY turn, role, text) AS texts
  FROM rows_ GROUP BY 1
),
placed AS (
  SELECT *, CASE
    WHEN roles = ['user', 'assistant'] AND conv_id % 3 <> 0 THEN 'prompt'
    WHEN roles = ['system', 'user', 'assistant'] AND texts[2] <> '' AND conv_id % 3 <> 0 THEN 'instruction'
    WHEN len(list_filter(roles, lambda r: r NOT IN ('user', 'assistant', 'system'))) = 0 AND conv_id % 3 = 1 THEN 'share'
    ELSE 'messages' END AS layout
  FROM convs
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss)::bigint AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars::bigint AS formatted_chars, layout, CASE layout {hashes} END AS layout_hash
FROM placed
"""


def turn_repair() -> str:
    """The cheapest edits by dynamic programming over rows: for each state the least
    (cost, edits) with the repaired text, as a struct; structs compare by their fields in turn."""
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    added = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def then(state: str, cost: str, edit: str, line: str | None) -> str:
        out = f"{state}.o" if line is None else f"{state}.o || CASE WHEN {state}.o = '' THEN '' ELSE chr(10) END || {line}"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {out}}}"

    def least(options: list[str]) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x.c IS NOT NULL))[1]"

    def consumed(to: int) -> str:
        options = [then(f"s{to}", "4", "D", None)]
        more = "CASE WHEN fault = 2 THEN 3 ELSE 0 END"
        for (state, letter), after in kept.items():
            if after == to:
                option = then(f"s{state}", more, "K", "role || ':' || text")
                options.append(f"CASE WHEN fault > 1 AND role[1] = '{letter}' THEN {option} END")
        for state, (role, after) in added.items():
            if after == to:
                option = then(f"s{state}", f"3 + {more}", "R", f"'{role}:' || text")
                options.append(f"CASE WHEN fault > 1 THEN {option} END")
        return least(options)

    def inserted(to: int) -> str:
        options = [f"s{to}"]
        options += [then(f"s{q}", "3", "I", f"'{role}:'") for q, (role, after) in added.items() if after == to]
        return least(options)

    closed = ", ".join(f"{inserted(q)} AS s{q}" for q in range(4))
    row = "conv_id, k"
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    return f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS name
  FROM conversations
),
dealt AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, i: {bit}, xor(c, b)), 4294967295::BIGINT)) % 20 AS fault
  FROM named
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dealt WHERE fault <> 0
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM damaged
),
judged AS (
  SELECT conv_id, turn, role, text, k, CASE
    WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 0 WHEN again THEN 1
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 2 ELSE 3 END AS fault,
    coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM numbered
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 0) AS blank, count(*) FILTER (fault = 1) AS duplicate,
    count(*) FILTER (fault = 2) AS truncated, count(*) FILTER (illegal) AS illegal, max(k) AS n
  FROM judged GROUP BY conv_id
),
walk AS (
  SELECT conv_id, 0::BIGINT AS k, {{'c': 0, 'a': '', 'o': ''}} AS s0,
    {{'c': NULL::INT, 'a': '', 'o': ''}} AS s1, {{'c': 3, 'a': 'I', 'o': 'user:'}} AS s2,
    {{'c': 6, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM counts
  UNION ALL
  SELECT {row}, s0, {inserted(1)} AS s1, s2, s3 FROM (
    SELECT {row}, s0, s1, s2, {inserted(3)} AS s3 FROM (
      SELECT {row}, {closed} FROM (
        SELECT j.conv_id, j.k, {", ".join(f"{consumed(q)} AS s{q}" for q in range(4))}
        FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.k = w.k + 1)))
),
final AS (
  SELECT w.conv_id, gaps, blank, duplicate, truncated, illegal, {least(["w.s0", "w.s3"])} AS best
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.k
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(best.o, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""
