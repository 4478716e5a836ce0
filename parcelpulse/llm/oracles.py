"""SQL for DuckDB that gives the rows of the queries that SQL can express, by plainer ways."""

from __future__ import annotations

from parcelpulse.llm.url_models import HELD_OUT, ORDER, RULES, SCORE_LIMIT, UNSEEN

SPACE = r"\x20\x09-\x0D"


def _crc32(number: str) -> str:
    """Unsigned crc32 of a decimal number, bit by bit."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    byte = (
        "list_reduce(list_concat([xor(c, b)], range(8)), "
        "lambda r, _: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)"
    )
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {byte}), 4294967295)"


CONVERSATION_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS k
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, count(*) AS n, {_crc32("conv_id")} % 6 AS h, conv_id - conv_id % 100 AS base
  FROM turns GROUP BY conv_id),
heads AS (
  SELECT c.conv_id, c.h, least(c.h, coalesce(b.n, 0)) AS taken, c.base
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT h.conv_id, t.k AS pos, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.base AND t.k < h.h
  UNION ALL
  SELECT h.conv_id, t.k - h.h + h.taken, t.role, t.text FROM heads h JOIN turns t USING (conv_id) WHERE t.k >= h.h),
seqs AS (
  SELECT h.conv_id,
         coalesce(list(md5(concat(r.role, chr(0), r.text)) ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS seq,
         coalesce(list(length(r.text) ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS chars
  FROM heads h LEFT JOIN rebuilt r USING (conv_id) GROUP BY h.conv_id),
members AS (
  SELECT conv_id, d, len(seq) = d AS ends, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars,
         concat(d, ':', md5(array_to_string(list_slice(seq, 1, d), ''))) AS node,
         CASE WHEN d > 0 THEN concat(d - 1, ':', md5(array_to_string(list_slice(seq, 1, d - 1), ''))) END AS parent
  FROM (SELECT conv_id, seq, chars, unnest(range(len(seq) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, min(parent) AS parent, min(conv_id) AS conv_id, min(d) AS depth, count(*) AS n_convs,
         (count(*) - 1) * min(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
sums AS (
  SELECT m.node, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.parent = n.node
  JOIN members m ON m.conv_id = n.conv_id AND m.d <= n.depth
  GROUP BY m.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.parent = n.node
JOIN sums s ON s.node = n.node
"""

PERIODIC_RUNS = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS words, {_crc32("doc_id")} AS h FROM documents),
placed AS (
  SELECT doc_id, words, h, len(words) AS n, (h // 10) % greatest(len(words), 1) AS a FROM texts),
periods AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
repeated AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN
           list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
         ELSE words END AS words FROM periods),
grams AS (
  SELECT doc_id, n, i, array_to_string(list_slice(words, i - 4, i + 1), chr(10)) AS gram
  FROM (SELECT doc_id, n, words, unnest(range(5, n)) AS i FROM repeated WHERE n >= 12)),
again AS (SELECT doc_id, gram FROM grams GROUP BY doc_id, gram HAVING count(*) > 1),
few AS (SELECT * FROM grams SEMI JOIN again USING (doc_id, gram)),
pairs AS (
  SELECT x.doc_id, y.i, y.i - x.i AS q FROM few x JOIN few y
  ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
diagonals AS (
  SELECT doc_id, q, min(i) AS low, max(i) AS high FROM (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island),
stretches AS (
  SELECT doc_id, low - 5 - q AS start, high - low + 6 + q AS length, q AS period FROM diagonals
  WHERE high - low + 6 + q >= greatest(12, 2 * q)),
runs AS (
  SELECT * FROM stretches r WHERE NOT EXISTS (
    SELECT 1 FROM stretches s WHERE s.doc_id = r.doc_id AND s.period < r.period
    AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
best AS (
  SELECT doc_id, count(*) AS n_runs, arg_max((start, length, period), (length, -start, -period)) AS top,
         string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM (
    SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM repeated) w
  WHERE NOT EXISTS (
    SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length)
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.n_runs, 0) AS n_runs, b.top[1] AS start, b.top[2] AS length, b.top[3] AS period,
       1000 * b.top[2] // b.top[3] AS exponent_milli, sha256(coalesce(b.listed, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


def _url_models() -> str:
    fits = []
    for verdict, host, path in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]))):
        test = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        fits.append((test, host + path, verdict))
    rule = " ".join(f"WHEN {test} THEN '{name}'" for test, name, _ in fits)
    label = " ".join(f"WHEN {test} THEN '{verdict}'" for test, _, verdict in fits)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    held = ", ".join(f"'{c}'" for c in HELD_OUT)
    ctes = [
        """after AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages)""",
        rf"""split AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{upper}', '{lower}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM after)""",
        f"""judged AS (
  SELECT *, concat(host, path) AS address, CASE {rule} END AS rule, CASE {label} END AS label FROM split)""",
        f"""texts AS (
  SELECT address, min(label) AS label, count(*) AS n,
         min(label) IS NOT NULL AND substr(md5(address), 1, 1) IN ({held}) AS held FROM judged GROUP BY address)""",
        f"""events AS (
  SELECT address, label, held, n, substr(padded, b, {ORDER + 1}) AS gram FROM (
    SELECT *, concat(repeat(chr(2), {ORDER}), address, chr(3)) AS padded, unnest(range(1, length(address) + 2)) AS b
    FROM texts))""",
        """counts AS (
  SELECT gram, sum(CASE WHEN label = 'allow' AND NOT held THEN n ELSE 0 END) AS allow,
         sum(CASE WHEN label = 'block' AND NOT held THEN n ELSE 0 END) AS block FROM events GROUP BY gram)""",
    ]
    for order in range(ORDER + 1):
        columns = []
        for kind in ("allow", "block"):
            wider = f"s.p_{kind}" if order else repr(UNSEEN)
            columns.append(
                f"CASE WHEN n_{kind} > 0 THEN ({kind} + d_{kind} * {wider}) / (n_{kind} + d_{kind}) ELSE {wider} END AS p_{kind}"
            )
        join = f"JOIN p{order - 1} s ON s.gram = substr(g.gram, 2)" if order else ""
        ctes.append(f"""p{order} AS (
  SELECT g.gram, {", ".join(columns)} FROM (
    SELECT *, sum(allow) OVER w AS n_allow, count(CASE WHEN allow > 0 THEN 1 END) OVER w AS d_allow,
           sum(block) OVER w AS n_block, count(CASE WHEN block > 0 THEN 1 END) OVER w AS d_block
    FROM (SELECT substr(gram, {ORDER + 1 - order}) AS gram, sum(allow) AS allow, sum(block) AS block
          FROM counts GROUP BY ALL)
    WINDOW w AS (PARTITION BY substr(gram, 1, {order}))) g {join})""")
    limit = 100 * SCORE_LIMIT
    ctes += [
        f"""scored AS (
  SELECT address, any_value(label) AS label, any_value(n) AS n, floor(avg(ln(p_allow) - ln(p_block)) * 100) AS step
  FROM events JOIN p{ORDER} USING (gram) WHERE label IS NULL OR held GROUP BY address)""",
        f"""tested AS (
  SELECT label, n, least(greatest(step, -{limit}), {limit}) AS step FROM scored WHERE label IS NOT NULL)""",
        """totals AS (
  SELECT sum(n) FILTER (WHERE label = 'allow') AS allow, sum(n) FILTER (WHERE label = 'block') AS block FROM tested)""",
        f"""errors AS (
  SELECT mark, round(coalesce(sum(n) FILTER (WHERE label = 'allow' AND step < mark), 0) / any_value(totals.allow)
                   + coalesce(sum(n) FILTER (WHERE label = 'block' AND step >= mark), 0) / any_value(totals.block), 9) AS error
  FROM tested, totals, (SELECT unnest(range(-{limit}, {limit + 2})) AS mark) GROUP BY mark)""",
        """least_error AS (
  SELECT coalesce((SELECT mark FROM errors WHERE error IS NOT NULL ORDER BY error, abs(mark), mark LIMIT 1), 0) AS mark)""",
    ]
    return (
        "WITH "
        + ",\n".join(ctes)
        + """
SELECT page_id, host, path, rule,
       coalesce(j.label, CASE WHEN s.step >= (SELECT mark FROM least_error) THEN 'allow' ELSE 'block' END) AS verdict
FROM judged j LEFT JOIN scored s ON s.address = j.address
"""
    )


ORACLES = {
    "op11_conversation_trie": CONVERSATION_TRIE,
    "op12_url_models": _url_models(),
    "op13_periodic_runs": PERIODIC_RUNS,
}
