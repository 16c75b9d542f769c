"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tickflow.llm import quality_rules as Q
from tickflow.llm import quotations as K

SPACE = "[\\x20\\x09-\\x0D]+"
A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _solid(x: str) -> str:
    return f"regexp_replace({x}, '{SPACE}', '', 'g')"


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SPACE}'), lambda y: y <> '')"


def _without(x: str, chars: str) -> str:
    return f"(length({x}) - length(translate({x}, '{chars}', '')))"


def line_fails(x: str) -> str:
    """The three line rules over the line ``x``."""
    white = f"(length({x}) - length({_solid(x)}) + 1)"
    symbols, marks = _without(x, Q.SYMBOLS), _without(x, "|»›•·")
    terminal = Q.TERMINAL.replace("'", "''")
    end = f"right(regexp_replace({x}, '{SPACE}$', ''), 1)"
    phrases = " OR ".join(f"contains(lower({x}), '{p}')" for p in Q.BOILERPLATE)
    return f"""(({marks} > 2 AND {marks} * 5 > {white})
      OR ({symbols} > 2 AND {symbols} * 5 > {white})
      OR (upper({x}) = {x} AND lower({x}) <> {x} AND length({x}) > 20)
      OR (NOT contains('{terminal}', {end}) AND len({_words(x)}) < {Q.SHORT_WORDS})
      OR (length({x}) < {Q.FURNITURE_CHARS} AND ({phrases})))"""


def op6_line_rules() -> str:
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 w AS (SELECT doc_id, t, {_words('t')} AS w,
              list_filter(string_split(t, chr(10)), lambda x: {_solid('x')} <> '') AS lines FROM d),
 x AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
 again AS (SELECT doc_id, i FROM x QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
 covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) r(k) GROUP BY doc_id),
 l AS (SELECT doc_id, len(lines) AS n_lines, list_distinct(lines) AS uniq FROM w),
 p AS (SELECT doc_id, n_lines, len(uniq) AS n_uniq,
              list_filter(uniq, lambda x: NOT {line_fails('x')}) AS passed FROM l),
 r AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length({_solid('t')}) AS BIGINT) AS word_chars,
              CAST({_without('t', Q.SYMBOLS)} AS BIGINT) AS n_symbols,
              CAST(n_lines - n_uniq AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
              CAST(n_lines AS BIGINT) AS n_lines, CAST(n_lines - len(passed) AS BIGINT) AS n_failed_lines,
              CAST(length({_solid("list_aggregate(passed, 'string_agg', '')")}) AS BIGINT) AS some_chars
       FROM w JOIN p USING (doc_id) LEFT JOIN covered USING (doc_id)),
 k AS (SELECT *, coalesce(some_chars, 0) AS kept_chars,
              n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 100 * (word_chars - kept_chars) > {Q.MAX_LOSS_PERCENT} * word_chars AS kept,
       n_lines, n_failed_lines, kept_chars
FROM k"""


def op3_quotations() -> str:
    marks = "^[ \\t]*(?:>[ \\t]?)+"
    announces = K.ANNOUNCES.replace("'", "''")

    def level(x):
        front = f"regexp_extract({x}, '{marks}', 0)"
        return f"(length({front}) - length(replace({front}, '>', '')))"

    norm = f"""lower(trim(regexp_replace(regexp_replace(line, '{marks}', ''), '[ \\t\\x0b\\f\\r]+', ' ', 'g')))"""
    own = f"""list_filter(lines, lambda x, i: {level('x')} = 0 AND NOT (regexp_matches(x, '{announces}')
              AND i < len(lines) AND {level("coalesce(lines[i + 1], '')")} > 0))"""
    return f"""WITH RECURSIVE l AS (
  SELECT conv_id, turn, {level('line')} AS lv, {norm} AS norm
  FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)),
 q AS (SELECT conv_id, turn, lv, norm, count(*) AS times FROM l WHERE lv > 0 AND norm <> '' GROUP BY ALL),
 quoted AS (SELECT conv_id, turn, sum(times) AS n_quoted, max(lv) AS max_level FROM q GROUP BY ALL),
 src AS (SELECT conv_id, norm, min(turn) AS source FROM l WHERE lv = 0 AND norm <> '' GROUP BY ALL),
 v AS (SELECT q.conv_id, q.turn, lv, source, sum(times) AS times
       FROM q JOIN src ON src.conv_id = q.conv_id AND src.norm = q.norm AND source < q.turn GROUP BY ALL),
 linked AS (SELECT conv_id, turn, source AS reply_to, sum(times) OVER (PARTITION BY conv_id, turn) AS n_linked FROM v
            QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY lv, times DESC, source DESC) = 1),
 r(conv_id, turn, root) AS (
   SELECT conv_id, turn, reply_to FROM linked
   UNION ALL SELECT r.conv_id, r.turn, p.reply_to FROM r JOIN linked p ON p.conv_id = r.conv_id AND p.turn = r.root),
 roots AS (SELECT conv_id, turn, min(root) AS root FROM r GROUP BY ALL),
 o AS (SELECT conv_id, turn, role,
              CASE WHEN contains(text, '>') THEN regexp_replace(array_to_string({own}, chr(10)),
                '^(?:[ \\t\\r]*\\n)+|(?:\\n[ \\t\\r]*)+$', '', 'g') ELSE text END AS text
       FROM (SELECT *, string_split(text, chr(10)) AS lines FROM conversations))
SELECT o.conv_id, o.turn, o.role, o.text, CAST(coalesce(n_quoted, 0) AS BIGINT) AS n_quoted,
       CAST(coalesce(max_level, 0) AS INTEGER) AS max_level, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, reply_to,
       coalesce(root, o.turn) AS thread_root,
       row_number() OVER (PARTITION BY o.conv_id ORDER BY coalesce(root, o.turn) NULLS FIRST, o.turn NULLS FIRST) - 1 AS pos
FROM o LEFT JOIN quoted USING (conv_id, turn) LEFT JOIN linked USING (conv_id, turn) LEFT JOIN roots USING (conv_id, turn)"""


def op9_jaccard(n: int = 4, percent: int = 85) -> str:
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id, {_words(f"translate(coalesce(text, ''), {A_Z})")} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {n - 1}) + 1)) AS i FROM w WHERE len(w) > 0)),
 c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
       GROUP BY a.doc_id, b.doc_id),
 e AS (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b
       WHERE 100 * n_both >= {percent} * (x.n + y.n - n_both)),
 r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, d.component_id
FROM (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) d LEFT JOIN c USING (doc_id)"""


def all_sql() -> dict[str, str]:
    return {"op3_quotations": op3_quotations(), "op6_line_rules": op6_line_rules(), "op9_jaccard": op9_jaccard()}
