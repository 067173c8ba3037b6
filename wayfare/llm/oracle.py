"""SQL equivalents, for DuckDB over the same tables, of the queries that SQL can express."""

from __future__ import annotations

# Pairs of documents that share a shingle are counted one by one: plain, and fit for small tables.
_NGRAM_JACCARD = """WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) END AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS i, b.doc_id AS j
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * COUNT(*) >= 90 * (a.n + b.n - COUNT(*))),
reached(i, j) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.i, l.j FROM reached r JOIN links l ON r.j = l.i),
smallest AS (SELECT i AS doc_id, MIN(j) AS component_id FROM reached GROUP BY i)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN smallest USING (doc_id)"""

_EMBEDDING_DEDUP = """WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS i, b.vec_id AS j FROM sound a JOIN sound b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached(i, j) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.i, l.j FROM reached r JOIN links l ON r.j = l.i),
smallest AS (SELECT i AS vec_id, MIN(j) AS component_id FROM reached GROUP BY i),
counts AS (SELECT i AS vec_id, COUNT(DISTINCT j) AS n FROM links GROUP BY i)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN smallest USING (vec_id) LEFT JOIN counts USING (vec_id)"""

# One vector of (cost, edits, repaired text) for the four states, carried from row to row. Strings that
# bring the same rows to the same state at the same cost never begin one with another, so the least
# beginning leads to the least whole. Structs compare by their fields in order.


def _edit(state: str, cost: str, letter: str, line: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'e': {state}.e || '{letter}', 'r': {state}.r || {line}}}"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _with_inserts(vector: str) -> str:
    """The states of a vector after a row without text may have been inserted."""
    user = [_edit(f"{vector}[{k}]", "5", "I", "'user:' || chr(10)") for k in (1, 2, 4)]
    assistant = _edit(f"{vector}[3]", "5", "I", "'assistant:' || chr(10)")
    return f"[{vector}[1], {vector}[2], {_least(f'{vector}[3]', *user)}, {_least(f'{vector}[4]', assistant)}]"


def _step(v: str = "v") -> str:
    """All edits of a row, for each state."""
    line = "role || ':' || text || chr(10)"
    user, assistant = ("'user:' || text || chr(10)", "'assistant:' || text || chr(10)")
    never = "999999999"
    system = [_edit(f"{v}[1]", f"IF(own = 's' AND stays, extra, {never})", "K", line)]
    to_user = [_edit(f"{v}[{k}]", f"IF(own = 'u' AND stays, extra, {never})", "K", line) for k in (1, 2, 4)]
    to_user += [_edit(f"{v}[{k}]", f"IF(stays, extra + 1, {never})", "R", user) for k in (1, 2, 4)]
    to_assistant = [_edit(f"{v}[3]", f"IF(own = 'a' AND stays, extra, {never})", "K", line)]
    to_assistant += [_edit(f"{v}[3]", f"IF(stays, extra + 1, {never})", "R", assistant)]
    more = [[], system, to_user, to_assistant]
    return f"[{', '.join(_least(_edit(f'{v}[{k + 1}]', '2', 'D'), *more[k]) for k in range(4))}]"


_CONVERSATION_REPAIR = f"""WITH RECURSIVE polynomial AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 20 AS kind
  FROM named, polynomial),
damaged AS (
  SELECT conv_id, turn, IF(kind = 4, 'user', role) AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(IF(kind = 3, [0, 1], [0])) AS copy
  FROM kinds WHERE kind <> 0),
ordered AS (
  SELECT conv_id, turn, role, text, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS visible,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM damaged),
faults AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS own,
    CASE WHEN visible = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(visible, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    i > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM ordered),
rows_ AS (
  SELECT conv_id, i, role, text, own, fault NOT IN ('b', 'd') AS stays, IF(fault = 't', 5, 0) AS extra FROM faults),
ids AS (SELECT DISTINCT conv_id FROM conversations),
begun AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, [{{'c': CAST(0 AS BIGINT), 'e': '', 'r': ''}}, {{'c': 99999, 'e': '', 'r': ''}},
    {{'c': 99999, 'e': '', 'r': ''}}, {{'c': 99999, 'e': '', 'r': ''}}] AS v FROM ids),
walked(conv_id, i, v) AS (
  SELECT conv_id, i, {_with_inserts('v')} FROM begun
  UNION ALL
  SELECT conv_id, i, {_with_inserts('w')} FROM (
    SELECT walked.conv_id, rows_.i AS i, {_step()} AS w FROM walked JOIN rows_
      ON walked.conv_id IS NOT DISTINCT FROM rows_.conv_id AND rows_.i = walked.i + 1) AS stepped),
ends AS (SELECT conv_id, arg_max({_least('v[1]', 'v[4]')}, i) AS best FROM walked GROUP BY conv_id),
sums AS (
  SELECT conv_id, MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn) AS gaps, SUM(IF(fault = 'b', 1, 0)) AS b,
    SUM(IF(fault = 'd', 1, 0)) AS d, SUM(IF(fault = 't', 1, 0)) AS t, SUM(IF(illegal, 1, 0)) AS x
  FROM faults GROUP BY conv_id)
SELECT ids.conv_id AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(b, 0) AS BIGINT) AS blank,
  CAST(coalesce(d, 0) AS BIGINT) AS duplicate, CAST(coalesce(t, 0) AS BIGINT) AS truncated,
  CAST(coalesce(x, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.e AS audit,
  sha256(best.r[:-2]) AS repaired_sha256
FROM ids JOIN ends ON ids.conv_id IS NOT DISTINCT FROM ends.conv_id
LEFT JOIN sums ON ids.conv_id IS NOT DISTINCT FROM sums.conv_id"""

LLM_ORACLE_SQL: dict[str, str] = {
    "op4_ngram_jaccard": _NGRAM_JACCARD,
    "op5_embedding_dedup": _EMBEDDING_DEDUP,
    "op12_conversation_repair": _CONVERSATION_REPAIR,
}
