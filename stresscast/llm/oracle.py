"""DuckDB SQL with the results of the registered queries, where SQL can express them."""

from __future__ import annotations

from stresscast.llm import mixing

_FOLDED = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# The test pages are plain: everything of the article is in h1 and p elements, and b and br are the only others.
_OP1 = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1),
                                               '\s+', ' ', 'g') AS x FROM pages),
b AS (SELECT page_id, url, list_filter(list_transform(
          string_split(regexp_replace(x, '</?(p|h1|br)>', chr(10), 'g'), chr(10)),
          lambda s: trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(s, '<[^>]*>', '', 'g'),
               '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda s: s <> '') AS l FROM a)
SELECT page_id, url, array_to_string(l, chr(10)) AS text, length(array_to_string(l, chr(10))) AS n_chars FROM b
"""

_OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_FOLDED} AS w FROM benchmark),
b2 AS (SELECT item, w, least(len(w), 13) AS m FROM b WHERE len(w) > 0),
pats AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS p
         FROM b2, unnest(range(1, len(w) - m + 2)) AS u(i)),
lens AS (SELECT DISTINCT m FROM pats),
wins AS (SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS p
         FROM d CROSS JOIN lens, unnest(range(1, len(w) - m + 2)) AS u(i)),
hits AS (SELECT rid, i, m, item FROM wins JOIN pats USING (m, p)),
words AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, m)) AS u(k) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN ids USING (rid)
"""

_OP7 = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, count(*) AS n,
             list(md5(coalesce('r' || role, 'n')) || md5(coalesce('t' || text, 'n')) ORDER BY turn, role, text) AS l,
             string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10)
                        || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS text
      FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT md5(array_to_string(l[1:k], '')) AS h FROM c, unnest(range(1, n)) AS u(k)),
e AS (SELECT *, md5(array_to_string(l, '')) AS h FROM c),
k AS (SELECT *, count(*) OVER (PARTITION BY h) AS n_equal,
             row_number() OVER (PARTITION BY h ORDER BY conv_id NULLS LAST) AS rn FROM e WHERE h NOT IN (SELECT h FROM p))
SELECT conv_id, n AS n_turns, n_equal, text FROM k WHERE rn = 1
"""


def _apportioned(table: str, group: str, order: str, votes: str, seats: str, out: str) -> str:
    """Highest quotients as a sub-query: every quotient that can win is listed and ranked."""
    return f"""
{out}_q AS (SELECT {group}, {order}, {seats} AS seats, CAST({votes} AS DOUBLE) / (2 * k + 1) AS quotient
            FROM (SELECT *, sum({votes}) OVER (PARTITION BY {group}) AS all_votes, count(*) OVER (PARTITION BY {group}) AS n
                  FROM {table}), unnest(range(0, CAST(ceil({votes} * ({seats} + n) / all_votes) AS BIGINT) + 2)) AS u(k)
            WHERE {votes} > 0),
{out}_r AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY quotient DESC, {order}) AS r FROM {out}_q),
{out}_s AS (SELECT {group}, {order}, count(*) AS {out} FROM {out}_r WHERE r <= seats GROUP BY ALL)"""


_OP4 = f"""
WITH s0 AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
            FROM documents),
tot AS (SELECT CAST(floor(coalesce(sum(size), 0) * 1.5) AS BIGINT) AS mixed FROM s0),
blk AS (SELECT mixed, greatest(1, (mixed + {mixing.N_BLOCKS - 1}) // {mixing.N_BLOCKS}) AS block FROM tot),
per AS (SELECT source, count(*) AS n_docs, CAST(sum(size) AS BIGINT) AS source_size FROM s0 GROUP BY source),
rnk AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM per),
wgt AS (SELECT *, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS DOUBLE) AS weight FROM rnk),
ful AS (SELECT *, source_size * 2.0::DOUBLE / weight AS full_at FROM wgt),
lvl AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
        - coalesce(sum(source_size) OVER (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2.0::DOUBLE)
        / sum(weight) OVER (ORDER BY full_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ful),
one AS (SELECT arg_min(level, rn) AS level FROM
        (SELECT *, row_number() OVER (ORDER BY full_at, rank) AS rn FROM lvl) WHERE level <= full_at),
src AS (SELECT source, rank, n_docs, source_size, least(source_size * 2.0::DOUBLE, weight * one.level) AS target,
               mixed // block AS blocks, CAST(ceil(n_docs / {mixing.SHARD_ROWS}::DOUBLE) AS BIGINT) AS shards, 1 AS one
        FROM lvl, one, blk),
{_apportioned("src", "one", "rank", "target", "blocks", "quota")},
plc AS (SELECT rid, doc_id, size, rank, source_size, target, coalesce(quota, 0) AS quota, shards,
               md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size) AS mark
        FROM s0 JOIN src ON s0.source IS NOT DISTINCT FROM src.source LEFT JOIN quota_s USING (rank)),
shd AS (SELECT *, CAST('0x' || mark[1:8] AS BIGINT) % shards AS shard FROM plc),
pos AS (SELECT *, CAST(sum(size) OVER (PARTITION BY rank, shard ORDER BY mark, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM shd),
sh AS (SELECT rank, shard, quota, CAST(sum(size) AS BIGINT) AS words FROM pos GROUP BY ALL),
{_apportioned("sh", "rank", "shard", "words", "quota", "got")},
tk AS (SELECT rank, shard, words, least(coalesce(got, 0) * block, words * 2) AS take
       FROM sh LEFT JOIN got_s USING (rank, shard), blk WHERE words > 0),
bl AS (SELECT rank, shard, b, take // words AS whole, take % words AS part, b * block AS lo, least(words, (b + 1) * block) AS hi,
              md5('42|' || rank || '|' || shard || '|' || b) AS mark
       FROM tk, blk, unnest(range(0, words // block + 1)) AS u(b)),
bt AS (SELECT *, greatest(0, least(hi - lo, part - coalesce(sum(hi - lo) OVER (PARTITION BY rank, shard ORDER BY mark, b
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS taken FROM bl),
ov AS (SELECT rid, sum(greatest(0, least(upto, lo + taken) - greatest(upto - size, lo))) AS got
       FROM (SELECT *, unnest(range((upto - size) // block, upto // block + 1)) AS b FROM pos, blk)
       JOIN bt USING (rank, shard, b) GROUP BY rid)
SELECT doc_id, size, source_size, target,
       CAST(size * coalesce(take // words, 0) + coalesce(got, 0) AS BIGINT) AS taken
FROM pos LEFT JOIN ov USING (rid) LEFT JOIN tk USING (rank, shard)
"""

# Bytes as two hex digits each; every window of 200 is listed.
_OP9 = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT rid, unnest(list_transform(range(0, len(h) // 400 + 1), lambda q: substr(h, CAST(400 * q + 1 AS BIGINT), 800))) AS b,
             unnest(range(0, len(h) // 400 + 1)) AS q FROM d),
l AS (SELECT rid, q, list_transform(range(0, greatest(0, least(200, len(b) // 2 - 199))),
                                    lambda i: md5(substr(b, CAST(2 * i + 1 AS BIGINT), 400))) AS l FROM b),
w AS (SELECT rid, unnest(l) AS k, 200 * q + unnest(range(0, len(l))) AS p FROM l),
r AS (SELECT rid, p, coalesce(p > lag(p) OVER (PARTITION BY rid ORDER BY p) + 200, true) AS fresh
      FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT rid, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY rid ORDER BY p) AS g FROM r),
s AS (SELECT rid, min(p) AS s, max(p) + 200 AS e FROM g GROUP BY rid, g),
k AS (SELECT rid, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS before FROM s),
t AS (SELECT rid, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans, max(e) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head
      FROM k JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (rid)
"""

_OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d, coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS e FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
             || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails
      FROM f LEFT JOIN l USING (doc_id)),
n AS (SELECT part, fails, good, toxic, count(*) AS n FROM m GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
s AS (SELECT n.*, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS filter,
             contains(fails, filter_order[step]) AS here,
             step > 1 AND len(translate(fails, filter_order[1:step - 1], '')) < len(fails) AS before
      FROM n, o, range(1, 6) AS r(step)),
g AS (SELECT part, filter_order, step, filter, CAST(coalesce(sum(n) FILTER (NOT here AND NOT before), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (here AND NOT before), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (here AND before), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (fails = filter), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(n) FILTER (here AND NOT before AND good), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(n) FILTER (here AND NOT before AND toxic), 0) AS BIGINT) AS toxic_lost
      FROM s GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM g
"""


ORACLE: dict[str, str] = {
    "op1_page_diff_text": _OP1,
    "op4_sainte_lague_mixing": _OP4,
    "op6_wu_manber_decontamination": _OP6,
    "op9_suffix_merge_dedup": _OP9,
    "op7_chat_snapshot_collapse": _OP7,
    "op12_filter_interaction_audit": _OP12,
}
