"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

from .decontamination import UNITS

_WORDS = r"list_filter(string_split_regex({},'[\x20\x09-\x0D]+'), lambda x: x<>'')"
_LOW = "translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')"

EMBEDDINGS = """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id<>b.vec_id AND list_cosine_similarity(a.e,b.e)>=0.95),
r(node, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT e.b, r.root FROM r JOIN e ON e.a=r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY 1), n AS (SELECT a, count(*) AS n FROM e GROUP BY 1)
SELECT v.vec_id, coalesce(n.n,0) AS n_links, c.component_id, c.component_id=v.vec_id AS kept FROM v JOIN c ON c.node=v.vec_id LEFT JOIN n ON n.a=v.vec_id"""

SUBSTRINGS = f"""WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text,'')")} AS w FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i+49],' ')) AS h FROM (SELECT doc_id, w, unnest(range(1,len(w)-48)) AS i FROM d WHERE len(w)>=50)),
f AS (SELECT h, min(doc_id) AS m FROM k GROUP BY 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i,i+50)) AS j FROM k JOIN f USING (h) WHERE f.m<doc_id),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1,len(w)+1)) AS j FROM d),
kept AS (SELECT doc_id, string_agg(word,' ' ORDER BY j) AS s, count(*) AS n FROM t ANTI JOIN g USING (doc_id, j) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, len(w)-coalesce(kept.n,0) AS n_removed, sha256(coalesce(kept.s,'')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOW)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4],' ') AS x FROM (SELECT doc_id, w, unnest(range(1,greatest(len(w)-4,1)+1)) AS i FROM d WHERE len(w)>0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x=b.x AND a.doc_id<b.doc_id GROUP BY 1,2),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id=a JOIN n q ON q.doc_id=b WHERE 100*c>=75*(p.n+q.n-c)), e AS (SELECT a,b FROM l UNION SELECT b,a FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a=r.node)
SELECT d.doc_id, coalesce(n.n,0) AS n_shingles, (SELECT min(root) FROM r WHERE node=d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id)"""

_TEMPLATE = f"CASE WHEN x BETWEEN '0' AND '9~' THEN '#n' WHEN list_contains({list(UNITS)!r}, lower(x)) THEN '#u' WHEN x=lower(x) OR length(x)=1 OR x=upper(x) THEN lower(x) ELSE '#p' END"

_TEMPLATES = f"CASE WHEN len(t)<5 AND len(list_filter(list_transform(t, lambda x: {_TEMPLATE}), lambda y: NOT starts_with(y,'#')))=0 THEN t ELSE list_transform(t, lambda x: {_TEMPLATE}) END"

LEAKS = f"""WITH i AS (SELECT item_id, regexp_extract_all(text,'\\p{{L}}+|[0-9][0-9.,:/]*') AS t FROM benchmark),
d AS (SELECT doc_id, regexp_extract_all(text,'\\p{{L}}+|[0-9][0-9.,:/]*') AS t FROM documents),
it AS (SELECT item_id, t, {_TEMPLATES} AS c FROM i), dt AS (SELECT doc_id, t, {_TEMPLATES} AS c FROM d),
iw AS (SELECT item_id, p AS ipos, t[p:p+4] AS iv, array_to_string(c[p:p+4],' ') AS w FROM (SELECT *, unnest(range(1,greatest(len(c)-3,2))) AS p FROM it WHERE len(c)>0)),
dw AS (SELECT doc_id, p AS dpos, t[p:p+4] AS dv, array_to_string(c[p:p+4],' ') AS w FROM (SELECT *, unnest(range(1,greatest(len(c)-3,2))) AS p FROM dt WHERE len(c)>0)),
n AS (SELECT item_id, count(*) AS n_windows FROM iw GROUP BY 1),
h AS (SELECT doc_id, item_id, ipos, dpos-ipos AS shift, iv, dv FROM iw JOIN dw USING (w)),
sv AS (SELECT doc_id, item_id, shift, ipos, unnest(iv) AS x, unnest(dv) AS y, unnest(range(0,5)) AS k FROM h),
sl AS (SELECT doc_id, item_id, shift, x AS value, min(y) AS lo, max(y) AS hi, count(DISTINCT ipos+k) AS n FROM sv WHERE x IS NOT NULL AND starts_with({_TEMPLATE},'#') GROUP BY 1,2,3,4),
st AS (SELECT doc_id, item_id, shift, bool_or(lo<>hi) AS torn, sum(n)::BIGINT AS n_slots, sum(CASE WHEN lo<>value THEN n ELSE 0 END)::BIGINT AS n_changed FROM sl GROUP BY 1,2,3),
fair AS (SELECT DISTINCT h.doc_id, h.item_id, h.shift, h.ipos, st.n_slots, st.n_changed FROM h LEFT JOIN st USING (doc_id, item_id, shift) WHERE NOT coalesce(st.torn,false)),
m AS (SELECT doc_id, item_id, count(DISTINCT ipos) AS n_matched FROM fair GROUP BY 1,2),
b AS (SELECT doc_id, item_id, max((n, n_slots, n_changed)) AS b FROM (SELECT doc_id, item_id, shift, count(*) AS n, any_value(n_slots) AS n_slots, any_value(n_changed) AS n_changed FROM fair GROUP BY 1,2,3) GROUP BY 1,2)
SELECT doc_id, item_id, n_windows, n_matched, coalesce(b[2],0) AS n_slots, coalesce(b[3],0) AS n_changed FROM m JOIN b USING (doc_id, item_id) JOIN n USING (item_id) WHERE n_matched>=0.75*n_windows"""

_SHARE = "(1+({}+1)::HUGEINT*1000000000//({}+k.v))"
_APART = "(({p}-{q})*({p}-{q})//{q})"

DIVERGENCE = f"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang,'') AS lang, coalesce(source,'') AS source, regexp_extract_all({_LOW},'[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM d), w AS (SELECT id, lang, source, unnest(t) AS term FROM d),
l AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1,2 HAVING count(DISTINCT id)>=3), k AS (SELECT lang, count(*) AS v, sum(n) AS n FROM l GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN l USING (lang, term) GROUP BY 1,2,3), s AS (SELECT g.lang, g.source, coalesce(sum(n),0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY 1,2),
p AS (SELECT s.lang, s.source, l.term, coalesce(c.n,0) AS n, {_SHARE.format("coalesce(c.n,0)", "s.n")} AS p, {_SHARE.format("l.n", "k.n")} AS q FROM s JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang=s.lang AND c.source=s.source AND c.term=l.term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum({_APART.format(p="a.p", q="b.p")}) AS value FROM p a JOIN p b ON a.lang=b.lang AND a.term=b.term AND a.source<>b.source GROUP BY 1,2,3),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value,0)::BIGINT AS value FROM g a JOIN g b ON a.lang=b.lang AND a.source<>b.source LEFT JOIN pv ON pv.lang=a.lang AND pv.source=a.source AND pv.item=b.source),
tr AS (SELECT lang, source, 'term' AS part, term AS item, {_APART.format(p="p", q="q")}::BIGINT AS value FROM p WHERE n>0 AND p>q)
SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM (FROM pr UNION ALL FROM tr)) WHERE part='pair' OR rank<=200"""
