"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .licenses import MIN_SCORE, PHRASES, SLIP, bodies

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+')"

OP6 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_SPACED} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
lk AS (SELECT x, y FROM pr JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
ed AS (SELECT x, y FROM lk UNION ALL SELECT y, x FROM lk),
reach AS (SELECT DISTINCT x AS a, x AS b FROM ed UNION SELECT reach.a, ed.y FROM reach JOIN ed ON reach.b = ed.x),
low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN low ON w.doc_id = low.doc_id"""

OP8 = f"""WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
ls AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, ls, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, i, dg.n, item FROM dg JOIN win ON dg.g = win.g AND dg.n = win.n),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
c AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN it ON d.doc_id = it.doc_id"""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> {s}) & 31) + 1, 1)"
_B32 = " || ".join(_DIGIT.format(s=s) for s in (15, 10, 5, 0))
OP9 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT x, g, CAST('0x' || substr(x, g * 5 + 1, 5) AS INTEGER) AS v FROM (SELECT DISTINCT x FROM p), unnest(range(0, 8)) AS t(g)),
b AS (SELECT x, string_agg({_B32}, '' ORDER BY g) AS digest FROM g GROUP BY x),
f AS (SELECT x, min(page_id) AS first FROM p GROUP BY x)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN b ON p.x = b.x JOIN f ON p.x = f.x"""


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_TEMPLATE_ROWS = ", ".join(f"({i}, '{label}', {_listed(body)}, {_listed(keys)}, {n})" for i, label, body, keys, n in bodies())


def _at(phrase: str) -> str:
    words = phrase.split()
    test = " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(words))
    return f"SELECT doc_id, i - 1 AS p, '{dict(PHRASES)[phrase]}' AS label FROM d, unnest(range(1, len(w) + 1)) AS t(i) WHERE {test}"


OP2 = f"""WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
tpl AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS v(template, label, body, keys, may_lack)),
voc AS (SELECT DISTINCT unnest(body) AS term FROM tpl),
df AS (SELECT term, count(*) AS df FROM (SELECT rowid, unnest(list_distinct(w)) AS term FROM (SELECT row_number() OVER () AS rowid, w FROM d)) JOIN voc USING (term) GROUP BY term),
pl AS (SELECT template, may_lack, body[a + 1] AS term, a FROM tpl, unnest(range(0, len(body))) AS t(a)),
an AS (SELECT * FROM (SELECT pl.*, df, may_lack - count(*) FILTER (df IS NULL) OVER (PARTITION BY template) AS still, row_number() OVER (PARTITION BY template ORDER BY df NULLS LAST, pl.term, a) AS r FROM pl LEFT JOIN df ON pl.term = df.term) WHERE df IS NOT NULL AND still >= 0 AND r <= still + 2),
hits AS (SELECT doc_id, w, template, i - 1 - a AS shift FROM (SELECT doc_id, w, w[i] AS term, i FROM d, unnest(range(1, len(w) + 1)) AS t(i)) x JOIN an ON x.term = an.term GROUP BY ALL HAVING count(DISTINCT a) >= 2),
al AS (SELECT doc_id, label, body, keys, shift, array_to_string(w[greatest(shift - {SLIP}, 0) + 1:shift + len(body) + {SLIP}], ' ') AS span,
  len(list_filter(range(0, len(body)), lambda k: shift + k + {SLIP} >= 0 AND list_contains(w[greatest(shift + k - {SLIP}, 0) + 1:shift + k + {SLIP} + 1], body[k + 1])))::DOUBLE / len(body) AS score
  FROM hits h JOIN tpl ON h.template = tpl.template),
ok AS (SELECT doc_id, label, score FROM al WHERE score >= {MIN_SCORE} AND len(list_filter(keys, lambda k: NOT contains(' ' || span || ' ', k))) = 0),
base AS ({" UNION ALL ".join(_at(p) for p, _ in PHRASES)}),
bs AS (SELECT doc_id, count(*) AS n_base, min(p)::BIGINT AS first_word, max(p)::BIGINT AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
lb AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM ok UNION SELECT doc_id, label FROM base) GROUP BY doc_id),
sc AS (SELECT doc_id, max(score) AS score FROM ok GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN bs ON d.doc_id = bs.doc_id LEFT JOIN lb ON d.doc_id = lb.doc_id LEFT JOIN sc ON d.doc_id = sc.doc_id"""
