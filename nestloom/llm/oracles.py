"""SQL counterparts of the operators 8 and 11 to 13."""

from __future__ import annotations

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


RANKED_SEARCH = f"""
    WITH d AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all({_lower("text")}, '{_TERM}')) AS term FROM documents),
    tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
    size AS MATERIALIZED (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
    q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all({_lower("text")}, '{_TERM}')) AS term FROM benchmark),
    w AS MATERIALIZED (
      SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf SEMI JOIN q USING (term), total GROUP BY term),
    s AS (
      SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * CAST(n AS BIGINT) * docs) // terms)))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id),
    r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50"""

# names of the states (before any turn, after s, after u, after a) and the state that a chosen role leads to
_NEXT = {"n": "u", "s": "u", "u": "a", "a": "u"}
_KEPT = {"n": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
_NAME = {"u": "user", "a": "assistant"}


def _edit(value: str, cost: str, letter: str, line: str | None) -> str:
    """SQL: the plan ``value`` (cost in nine digits and audit; lines) with one edit in front."""
    lines = f"{value}.t" if line is None else f"list_prepend({line}, {value}.t)"
    return f"{{'k': printf('%09d', CAST({value}.k[1:9] AS BIGINT) + {cost}) || '{letter}' || {value}.k[10:], 't': {lines}}}"


def _turn(state: str) -> str:
    following = _NEXT[state]
    keeps = " ".join(f"WHEN role[1:1] = '{r}' THEN {_edit(f'p.{to}', 'extra', 'K', chr(39) * 2 + ' || role || ' + chr(39) + ':' + chr(39) + ' || text')}" for r, to in _KEPT[state].items())
    kept = f"CASE WHEN gone THEN NULL {keeps} END"
    named = f"CASE WHEN NOT gone THEN {_edit(f'p.{following}', '3 + extra', 'R', f'{chr(39)}{_NAME[following]}:{chr(39)} || text')} END"
    return f"least({_edit(f'p.{state}', '4', 'D', None)}, {kept}, {named})"


def _inserted(table: str, state: str, after: str) -> str:
    following = _NEXT[state]
    return f"least({table}.{state}, {_edit(f'{after}.{following}', '3', 'I', f'{chr(39)}{_NAME[following]}:{chr(39)}')})"


_CRC = (
    "xor(list_reduce(list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(k, '')]), lambda c, b: "
    "list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"
)
_GIVEN = "{'k': '00000000%s', 't': %s}"

TURN_REPAIR = rf"""
    WITH RECURSIVE k AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    c AS (SELECT *, {_CRC} % 20 AS fate FROM k),
    d AS (
      SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM c WHERE fate <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
    f AS MATERIALIZED (
      SELECT conv_id, turn, role, text, i, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
        lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
    g AS MATERIALIZED (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM f),
    p AS (
      SELECT conv_id, max(i) + 1 AS i, {_GIVEN % ("0", "CAST([] AS VARCHAR[])")} AS n, {_GIVEN % ("6II", "['user:', 'assistant:']")} AS s,
        {_GIVEN % ("3I", "['assistant:']")} AS u, {_GIVEN % ("0", "CAST([] AS VARCHAR[])")} AS a
      FROM g GROUP BY conv_id
      UNION ALL
      SELECT conv_id, i, {", ".join(f"{_inserted('y', q, 'z')} AS {q}" for q in "nsua")}
      FROM (SELECT conv_id, i, y, {{{", ".join(f"'{q}': {_inserted('y', q, 'y')}" for q in "nsua")}}} AS z
        FROM (SELECT p.conv_id, p.i - 1 AS i, {{{", ".join(f"'{q}': {_turn(q)}" for q in "nsua")}}} AS y
          FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.i = p.i - 1))),
    best AS (SELECT conv_id, n FROM p WHERE i = 1),
    counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before[1:1] || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal
      FROM g GROUP BY conv_id),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT ids.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
      CAST(coalesce(CAST(n.k[1:9] AS BIGINT), 0) AS BIGINT) AS cost, coalesce(n.k[10:], '') AS audit,
      sha256(coalesce(array_to_string(n.t, chr(10)), '')) AS repaired_sha256
    FROM ids LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id"""

#: What the pages mark as their article themselves: the query, which does without that mark's help, has to find the same.
PAGE_TEXT = r"""
    WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?is)<article[^>]*>(.*)</article>', 1) AS x FROM pages),
    b AS (SELECT page_id, url, unnest(regexp_split_to_array(x, '(?i)</?(?:p|h1|div|li|ul)(?:\s[^>]*)?>')) AS line, generate_subscripts(regexp_split_to_array(x, '(?i)</?(?:p|h1|div|li|ul)(?:\s[^>]*)?>'), 1) AS i FROM a),
    c AS (SELECT page_id, url, i, regexp_replace(regexp_replace(line, '(?i)<br[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g') AS line FROM b),
    d AS (SELECT page_id, url, i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS line FROM c),
    e AS (SELECT page_id, url, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (line <> ''), '') AS text FROM d GROUP BY page_id, url)
    SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM e"""


_ADDRESS, _NUMBER = r"[\w.+-]+@[\w-]+\.\w+", r"\+?\d[\d ()./-]{8,}\d"
_TOPIC = rf"""CASE WHEN regexp_matches(x, '(?i)\b(licen[sc]ed?|copyright|warrant(y|ies)|all rights reserved)\b') THEN 'legal'
      WHEN (contains(x, '@') AND regexp_matches(x, '{_ADDRESS}')) OR regexp_matches(x, '{_NUMBER}') THEN 'contact'
      WHEN regexp_matches(x, '</?[a-z]+[^<>]*>|[{{}};]\s*\n| \| ') THEN 'markup' ELSE 'prose' END"""


def mixing_sql(shares: dict[str, dict[str, float]], keep: float, rounds: int, seed: int) -> str:
    """Raking written out, one table for each step; goals that a value can't reach are levelled by one running sum."""
    tables = [
        f"""d AS MATERIALIZED (
          SELECT doc_id, source AS src, lang AS lng, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {_TOPIC} AS topic,
            greatest(1, strlen(x)) AS tokens,
            CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || x), 1, 10) AS BIGINT) / 1099511627776.0 AS draw
          FROM (SELECT *, coalesce(text, '') AS x FROM documents))""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL)",
        "whole AS MATERIALIZED (SELECT sum(tokens) AS whole FROM cells)",
    ]
    for m in ("source", "lang", "topic"):
        given = ", ".join(f"('{v}', {w})" for v, w in shares.get(m, {}).items())
        wanted = f"(VALUES {given}) AS g({m}, target)" if given else f"(SELECT DISTINCT {m}, 1.0 AS target FROM cells) AS g"
        tables += [
            f"""asked_{m} AS MATERIALIZED (
              SELECT {m}, goal / sum(goal) OVER () AS goal, most FROM (
                SELECT {m}, CAST(coalesce(max(target), sum(tokens) / max(whole)) AS DOUBLE) AS goal, sum(tokens) / ({keep} * max(whole)) AS most
                FROM cells LEFT JOIN {wanted} USING ({m}), whole GROUP BY {m}))""",
            # the values in the order in which growing goals reach what there is; growth after each of them is whole
            f"""grown_{m} AS MATERIALIZED (
              SELECT *, (1 - coalesce(sum(most) OVER before, 0)) / sum(goal) OVER rest AS growth FROM asked_{m}
              WINDOW before AS (ORDER BY most / goal, {m} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                rest AS (ORDER BY most / goal, {m} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
            f"""goal_{m} AS MATERIALIZED (
              SELECT {m}, least(most, goal * (SELECT max(growth) FROM grown_{m} WHERE growth <= most / goal)) AS goal FROM grown_{m})""",
            f"{m}0 AS MATERIALIZED (SELECT {m}, CAST(1 AS DOUBLE) AS f_{m} FROM asked_{m})",
        ]
    now = {"source": "source0", "lang": "lang0", "topic": "topic0"}

    def weighted() -> str:
        joined = " ".join(f"JOIN {t} USING ({m})" for m, t in now.items())
        free = "tokens / whole * f_source * f_lang * f_topic"
        return f"(SELECT *, least(free, most) AS weight FROM (SELECT *, {free} AS free, tokens / ({keep} * whole) AS most FROM cells {joined}, whole))"

    for n in range(1, rounds + 1):
        for m in now:
            tables.append(f"""{m}{n} AS MATERIALIZED (
              SELECT {m}, f * CASE WHEN w <= 0 THEN 1 WHEN w - whole_ones > 1e-9 * w AND goal - whole_ones > 1e-9 * goal THEN (goal - whole_ones) / (w - whole_ones)
                  WHEN w - whole_ones <= 1e-9 * w AND goal - whole_ones >= -1e-9 * goal THEN 1 ELSE goal / w END AS f_{m}
              FROM (SELECT {m}, sum(weight) AS w, sum(CASE WHEN free >= most * (1 - 1e-9) THEN most ELSE 0 END) AS whole_ones, any_value(f_{m}) AS f
                FROM {weighted()} GROUP BY {m}) JOIN goal_{m} USING ({m}))""")
            now[m] = f"{m}{n}"
    return f"""WITH {", ".join(tables)},
        p AS MATERIALIZED (SELECT source, lang, topic, least(1.0, weight * {keep} * whole / tokens) AS p FROM {weighted()})
        SELECT doc_id, src AS source, lng AS lang, topic, CAST(tokens AS BIGINT) AS tokens, round(p, 6) AS probability, draw < p AS kept
        FROM d JOIN p USING (source, lang, topic)"""
