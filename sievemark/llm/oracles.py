"""DuckDB SQL for the queries that SQL can express, all over whole tables."""

from __future__ import annotations

from .license_scan import CONTAINED, TEMPLATES, WORDS

_COMPONENTS = """walk(id, c) AS (SELECT id, id FROM nodes UNION SELECT l.v, w.c FROM walk w JOIN links l ON l.u = w.id WHERE w.c < l.v), comp AS (SELECT id, min(c) AS c FROM walk GROUP BY 1)"""

OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), s AS (SELECT page_id, h, strlen(h) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
n AS (SELECT *, list_transform(range(4), lambda i: ('0x' || substr(x, 1 + 10 * i, 10))::UBIGINT) AS parts FROM s)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, array_to_string(list_transform(parts, lambda v: array_to_string(list_transform(range(8), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> (35 - 5 * k)::UBIGINT) & 31)::INTEGER + 1, 1)), '')), '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM n"""

OP2 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(len(ws) - 2), lambda i: ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS sh FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n, hash(list_sort(sh)) AS g, sh FROM s), cls AS (SELECT g, n, min(doc_id) AS id FROM n WHERE n > 0 GROUP BY 1, 2), e AS (SELECT id, unnest(sh) AS x FROM n JOIN cls ON doc_id = id),
i AS (SELECT a.id AS u, b.id AS v, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY 1, 2), near AS (SELECT u, v FROM i JOIN cls a ON a.id = u JOIN cls b ON b.id = v WHERE 100 * k >= 85 * (a.n + b.n - k)),
links AS (SELECT u, v FROM near UNION ALL SELECT v, u FROM near), nodes AS (SELECT id FROM cls), {_COMPONENTS}
SELECT doc_id, n.n AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM n LEFT JOIN cls ON cls.g = n.g AND cls.n = n.n LEFT JOIN comp ON comp.id = cls.id"""


def _op3() -> str:
    from .license_scan import _classes, windows

    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
    split = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    shingle = f"CASE WHEN len(ws) >= {WORDS} THEN list_transform(range(len(ws) - {WORDS - 1}), lambda i: " + " || ' ' || ".join(f"ws[i + {k}]" for k in range(1, WORDS + 1)) + ") ELSE []::VARCHAR[] END"
    import re

    sizes = [len({tuple(w[i : i + WORDS]) for i in range(len(w) - WORDS + 1)}) for w in ([x for x in re.split(r"[\W_]+", t.lower()) if x] for t in TEMPLATES.values())]
    classes = _classes(sizes)
    cases = " ".join(f"WHEN n <= {c} THEN {{'w': {windows(c)[0]}, 's': {windows(c)[1]}}}" for c in sorted(classes))
    return f"""
WITH t(name, text) AS (VALUES {rows}), tw AS (SELECT name, {split} AS ws FROM t), ts AS (SELECT name, unnest(list_distinct({shingle})) AS x FROM tw), tn AS (SELECT name, count(*) AS n, CASE {cases.replace('n <=', 'count(*) <=')} END AS win FROM ts GROUP BY 1),
dw AS (SELECT doc_id, {split} AS ws FROM documents), ds AS (SELECT doc_id, unnest({shingle}) AS x, generate_subscripts({shingle}, 1) - 1 AS pos FROM dw),
h AS (SELECT doc_id, name, x, pos, n, win.w AS w, win.s AS s FROM ds JOIN ts USING (x) JOIN tn USING (name)),
k AS (SELECT doc_id, name, n, unnest(range(greatest(0, (pos - w) // s + CASE WHEN pos >= w THEN 1 ELSE 0 END)::BIGINT, (pos // s + 1)::BIGINT)) AS i, x FROM h),
m AS (SELECT DISTINCT doc_id, name FROM (SELECT doc_id, name, i FROM k GROUP BY doc_id, name, i, n HAVING count(DISTINCT x) >= {CONTAINED}::DOUBLE * n))
SELECT d.doc_id, count(name) AS n_licenses, coalesce(string_agg(name, ',' ORDER BY name), '') AS licenses FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN m USING (doc_id) GROUP BY 1"""


_VECTORS = "v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"

OP9 = f"""
WITH {_VECTORS}, i AS (SELECT vec_id, list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS q FROM v),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(range(len(a.q)), lambda k: a.q[k + 1] * b.q[k + 1]))::BIGINT AS score FROM i a JOIN i b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

OP10 = f"""
WITH RECURSIVE {_VECTORS}, near AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
links AS (SELECT u, v FROM near), nodes AS (SELECT vec_id AS id FROM embeddings), {_COMPONENTS}, n AS (SELECT u, count(*) AS n FROM near GROUP BY 1)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, c AS component_id, c = id AS kept FROM comp LEFT JOIN n ON u = id"""

ORACLES: dict[str, str] = {"op1_warc": OP1, "op2_minhash": OP2, "op3_license_scan": _op3(), "op9_topk": OP9, "op10_embedding_dedup": OP10}
