"""The same results as DuckDB SQL, written apart from the Spark code."""

ORACLE: dict[str, str] = {}

_SPACE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE["op8_line_dedup"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos, len(lines) AS n FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

ORACLE["op5_maxscore"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT row_number() OVER (ORDER BY vec_id) AS n, * FROM v),
s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM n q, n c WHERE q.vec_id % 50 = 0 AND q.n <> c.n),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op10_chosen_path"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

# CRC-32 of an ASCII string, bit by bit
_CRC = (
    "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length({s}) + 1), lambda i: CAST(ascii(substr({s}, i, 1)) AS BIGINT))), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)

ORACLE["op13_prefix_trie"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS own,
  {_CRC.format(s="CAST(conv_id AS VARCHAR)")} % 6 AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS turns FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, d, turns[1:d] AS node, turns[d].text AS last, len(turns) = d AS ended FROM r, unnest(range(0, len(turns) + 1)) u(d)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(length(last)) AS chars,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256 FROM p GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.d > 0 THEN (n.n_convs - 1) * n.chars ELSE 0 END AS own, CASE WHEN k.node IS NULL THEN 1 ELSE 0 END AS leaf
  FROM n LEFT JOIN k ON k.node = n.node AND k.d = n.d),
s AS (SELECT p.node, p.d, sum(f.leaf) AS n_leaves, sum(f.own) AS saved_tokens FROM p JOIN f ON f.conv_id = p.conv_id AND f.d >= p.d GROUP BY p.node, p.d)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.node = f.node AND s.d = f.d LEFT JOIN n q ON f.d > 0 AND q.d = f.d - 1 AND q.node = f.node[1:f.d - 1]
"""


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _more(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


# cost and least audit in each state of the pattern (start, system, user, assistant), after up to two inserts, then after a row
_ONE_U = _more(_least("{s}[1]", "{s}[2]", "{s}[4]"), "5", "I")
_ONE_A = _more("{s}[3]", "5", "I")
_INSERTED = f"[{{s}}[1], {{s}}[2], {_least('{s}[3]', _ONE_U, _more(_ONE_A, '5', 'I'))}, {_least('{s}[4]', _ONE_A, _more(_ONE_U, '5', 'I'))}]"


def _inserted(s: str) -> str:
    return _INSERTED.replace("{s}", s)


def _after_row(w: str, code: str) -> str:
    far = f"CASE WHEN {code} IN ('1', '2', '3', '4') THEN 100000000 ELSE 0 END + CASE WHEN {code} = upper({code}) THEN 5 ELSE 0 END"
    to_user, to_assistant = _least(f"{w}[1]", f"{w}[2]", f"{w}[4]"), f"{w}[3]"
    no = lambda letter: f"CASE WHEN lower({code}) = '{letter}' THEN 0 ELSE 100000000 END + {far}"
    return (
        f"[{_more(f'{w}[1]', '2', 'D')}, {_least(_more(f'{w}[2]', '2', 'D'), _more(f'{w}[1]', no('s'), 'K'))}, "
        f"{_least(_more(f'{w}[3]', '2', 'D'), _more(to_user, f'1 + {far}', 'R'), _more(to_user, no('u'), 'K'))}, "
        f"{_least(_more(f'{w}[4]', '2', 'D'), _more(to_assistant, f'1 + {far}', 'R'), _more(to_assistant, no('a'), 'K'))}]"
    )


_FAR = "{'c': CAST(1000000000000 AS BIGINT), 'a': '~'}"
_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

ORACLE["op11_repair"] = f"""
WITH e AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format(s="(" + _KEY + ")")} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM e WHERE kind <> 0),
o AS (SELECT *, left(role, 1) AS initial, rtrim(text, {_SPACE}) AS body,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(role, 1), sha256(length(role) || ':' || role || text), copy) AS k FROM d),
f AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM o),
g AS (SELECT *, substr(CASE WHEN fault IS NULL THEN 'suao' WHEN fault = 'truncated' THEN 'SUAO' ELSE '1234' END,
  CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 4 END, 1) AS code FROM f),
h AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (k > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, list(code ORDER BY k) AS codes FROM g GROUP BY conv_id),
w AS (SELECT * EXCLUDE (codes), list_reduce(list_prepend({{'x': '', 's': [{{'c': CAST(0 AS BIGINT), 'a': ''}}, {_FAR}, {_FAR}, {_FAR}]}},
  list_transform(codes, lambda q: {{'x': q, 's': [{_FAR}]}})), lambda p, q: {{'x': q.x, 's': {_after_row("list_transform([p.s], lambda s: " + _inserted("s") + ")[1]", "q.x")}}}).s AS s FROM h),
b AS (SELECT * EXCLUDE (s), list_sort([s[1], {_inserted("s")}[4]])[1] AS best FROM w),
l AS (SELECT conv_id, unnest(string_split(best.a, '')) AS letter, generate_subscripts(string_split(best.a, ''), 1) AS j FROM b WHERE best.a <> ''),
m AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS k FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY j) AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM m WHERE letter <> 'D'),
r AS (SELECT n.conv_id, pos, CASE WHEN letter = 'K' THEN o.role WHEN (pos - 1 - n % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE o.text END AS line
  FROM n LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM n.conv_id AND o.k = n.k),
t AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY pos)) AS sha FROM r GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
