"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threshmill.llm.alignment import op11_alignment
from threshmill.llm.branch_merge import op12_branch_merge
from threshmill.llm.bwt_dedup import op8_bwt_dedup
from threshmill.llm.chat import op3_chat
from threshmill.llm.embeddings import op5_embedding_dedup
from threshmill.llm.html import op1_html
from threshmill.llm.mixing import op7_mixing
from threshmill.llm.ngram_join import op9_ngram_join
from threshmill.llm.packing import op10_packing
from threshmill.llm.sstable import op2_sstable
from threshmill.llm.syncmers import op4_syncmers
from threshmill.llm.toxicity import op6_toxicity
from threshmill.llm.vector_search import op13_vector_search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_sstable": op2_sstable,
    "op3_chat": op3_chat,
    "op4_syncmers": op4_syncmers,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_bwt_dedup": op8_bwt_dedup,
    "op9_ngram_join": op9_ngram_join,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_branch_merge": op12_branch_merge,
    "op13_vector_search": op13_vector_search,
}
#: Components of links (a, b) among nodes, by the smallest node that each reaches.
_REACHED = """sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links), reach(node, least) AS (SELECT a, a FROM sides UNION SELECT sides.b, reach.least FROM reach JOIN sides ON reach.node = sides.a),
part AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node)"""


def _crc32(text: str) -> str:
    """SQL of the crc32 of a text of ASCII letters, by the table ``t``."""
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: {step}), 4294967295)"


#: Counters by change of each branch, equality, and the counter of a clash.
_KIND = "CASE WHEN {l} AND {r} AND NOT {same} THEN {clash} WHEN {l} OR {r} THEN 1 ELSE 0 END"
_PLANTED = r"'\### Assistant: </turn> ok'"
ORACLE_SQL: dict[str, str] = {
    "op3_chat": rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', {_PLANTED} UNION ALL SELECT -7, 1, 'assistant', {_PLANTED})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(14 + length(regexp_replace(role, '[\\#<:]', 'xx', 'g')) + length(regexp_replace(text, '[\\#<]', 'xx', 'g')))::BIGINT AS formatted_chars FROM c GROUP BY conv_id""",
    "op5_embedding_dedup": f"""WITH RECURSIVE u AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM u WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND x.norm > 0 AND y.norm > 0 AND list_dot_product(x.v, y.v) >= 0.9 * x.norm * y.norm), {_REACHED}, many AS (SELECT a, count(*) AS n_links FROM sides GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept FROM embeddings LEFT JOIN many ON many.a = vec_id LEFT JOIN part ON part.node = vec_id""",
    "op8_bwt_dedup": """WITH d AS (SELECT doc_id, row_number() OVER () AS k, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT k, i, md5(b[i : i + 399]) AS h FROM (SELECT k, b, unnest(range(1, n - 398)) AS i FROM d WHERE n >= 400)), r AS (SELECT k, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
m AS (SELECT k, i, coalesce(i > lag(i) OVER (PARTITION BY k ORDER BY i) + 400, true)::INT AS fresh FROM r), g AS (SELECT k, i, sum(fresh) OVER (PARTITION BY k ORDER BY i) AS span FROM m), s AS (SELECT k, span, min(i) AS lo, max(i) + 399 AS hi FROM g GROUP BY 1, 2),
p AS (SELECT s.k, span, hi - lo + 1 AS gone, hex(b[coalesce(lag(hi) OVER o, 0) + 1 : lo - 1]) AS before, CASE WHEN lead(lo) OVER o IS NULL THEN hex(b[hi + 1 : n]) ELSE '' END AS rest FROM s JOIN d USING (k) WINDOW o AS (PARTITION BY s.k ORDER BY span)),
a AS (SELECT k, sum(gone) AS gone, count(*) AS n_spans, string_agg(before || rest, '' ORDER BY span) AS kept FROM p GROUP BY k)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN gone IS NULL THEN b ELSE unhex(kept) END) AS kept_sha256 FROM d LEFT JOIN a USING (k)""",
    "op9_ngram_join": rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s), t AS (SELECT doc_id, hash(unnest(s)) AS t FROM s), shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM t x JOIN t y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)), {_REACHED}
SELECT n.doc_id, n::BIGINT AS n_shingles, coalesce(component_id, n.doc_id) AS component_id FROM n LEFT JOIN part ON part.node = n.doc_id""",
    "op12_branch_merge": f"""WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
names AS (SELECT k, doc_id, unnest(['row', 'lang', 'source']) AS name, -1 AS i, unnest(['', lang, source]) AS base FROM d UNION ALL SELECT k, doc_id, i::VARCHAR, i, lines[i + 1] FROM (SELECT k, doc_id, lines, unnest(range(len(lines))) AS i FROM d)),
c AS (SELECT k, name, i, base, {_crc32("concat('L:', doc_id, ':', name)")} % 7 AS l, {_crc32("concat('R:', doc_id, ':', name)")} % 7 AS r FROM names, t),
w AS (SELECT k, l = 0 AS gl, r = 0 AS gr, l IN (3, 4) AS al, r IN (3, 4) AS ar, l = r AS same, CASE WHEN CASE WHEN r IN (3, 4) THEN r ELSE l END = 3 THEN '!' ELSE '?' END AS added FROM c WHERE name = 'row'),
sides AS (SELECT k, name, base, CASE l WHEN 0 THEN '' WHEN 1 THEN base || '!' WHEN 2 THEN base || '?' ELSE base END AS lv, CASE r WHEN 0 THEN '' WHEN 1 THEN base || '!' WHEN 2 THEN base || '?' ELSE base END AS rv FROM c WHERE name IN ('lang', 'source')),
cols AS (SELECT k, name, lv <> base AS tl, rv <> base AS tr, CASE WHEN gl OR rv <> base THEN rv ELSE lv END AS v, {_KIND.format(l="lv <> base", r="rv <> base", same="(lv = rv)", clash=2)} AS kind FROM sides JOIN w USING (k)),
edits AS (SELECT k, i, base, l <= 4 AS tl, r <= 4 AS tr, CASE WHEN gl THEN 6 ELSE l END AS l, r FROM c JOIN w USING (k) WHERE i >= 0),
states AS (SELECT k, i, base, tl, tr, CASE WHEN r <= 2 THEN r WHEN l <= 2 THEN l ELSE 6 END AS own, CASE WHEN r IN (3, 4) THEN r WHEN l IN (3, 4) THEN l ELSE 6 END AS put,
 {_KIND.format(l="l <= 2", r="r <= 2", same="(l = r)", clash="(CASE WHEN l = 0 OR r = 0 THEN 3 ELSE 2 END)")} AS kind, {_KIND.format(l="l IN (3, 4)", r="r IN (3, 4)", same="(l = r)", clash=4)} AS gap FROM edits),
pieces AS (SELECT k, 2 * i AS place, CASE own WHEN 1 THEN base || '!' WHEN 2 THEN base || '?' ELSE base END AS x FROM states WHERE own <> 0 UNION ALL SELECT k, 2 * i + 1, CASE put WHEN 3 THEN '!' ELSE '?' END FROM states WHERE put < 6),
texts AS (SELECT k, string_agg(x, chr(10) ORDER BY place) AS text FROM pieces GROUP BY k),
kinds AS (SELECT k, kind, tl, tr FROM cols UNION ALL SELECT k, kind, tl, tr FROM states UNION ALL SELECT k, gap, false, false FROM states),
n AS (SELECT k, bool_or(tl) AS tl, bool_or(tr) AS tr, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2, count(*) FILTER (kind = 3) AS n3, count(*) FILTER (kind = 4) AS n4 FROM kinds GROUP BY k),
f AS (SELECT *, CASE WHEN gl AND gr THEN 1 WHEN gl THEN CASE WHEN tr THEN 3 ELSE 1 END WHEN gr THEN CASE WHEN tl THEN 3 ELSE 1 END ELSE 0 END AS fate FROM n JOIN w USING (k)),
g AS (SELECT *, fate = 0 OR (fate = 3 AND NOT gr) AS stays FROM f)
SELECT doc_id, CASE WHEN stays THEN a.v END AS lang, CASE WHEN stays THEN b.v END AS source, CASE WHEN stays THEN sha256(coalesce(text, '')) END AS text_sha256, CASE WHEN fate = 0 THEN n1 ELSE (fate = 1)::BIGINT END AS n_clean, CASE WHEN fate = 0 THEN n2 ELSE 0 END AS n_edit_edit,
 CASE WHEN fate = 0 THEN n3 ELSE (fate = 3)::BIGINT END AS n_edit_delete, CASE WHEN fate = 0 THEN n4 ELSE 0 END AS n_insert_insert FROM d JOIN g USING (k) JOIN cols a ON a.k = d.k AND a.name = 'lang' JOIN cols b ON b.k = d.k AND b.name = 'source' LEFT JOIN texts ON texts.k = d.k
UNION ALL SELECT -1 - doc_id, lang, source, sha256(added), (NOT (al AND ar AND NOT same))::BIGINT, 0, 0, (al AND ar AND NOT same)::BIGINT FROM d JOIN w USING (k) WHERE al OR ar""",
    "op13_vector_search": """WITH n AS (SELECT row_number() OVER () AS k, vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
r AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score, row_number() OVER (PARTITION BY q.k ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank FROM n q JOIN n c ON q.k <> c.k AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""",
}
