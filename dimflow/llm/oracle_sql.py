"""DuckDB SQL for the ``opN_`` queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


def _spans(kind: str, pattern: str, group: int = 0) -> str:
    """A CTE of one row per match: where the match starts is what all pieces and matches before it take up."""
    pattern = pattern.replace("'", "''")
    parts = f"regexp_extract_all(t, '{pattern}', {group})"
    return f"""{kind}_m AS (
  SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS pieces,
         {parts} AS parts FROM d WHERE regexp_matches(t, '{pattern}')),
{kind}_p AS (
  SELECT doc_id, t, unnest(hits) AS hit, unnest(parts) AS part, unnest(range(1, len(hits) + 1)) AS i,
         list_transform(hits, lambda x: length(x)) AS h, list_transform(pieces, lambda x: length(x)) AS p FROM {kind}_m),
{kind}_s AS (
  SELECT doc_id, t, hit, part,
         (list_sum(p[1:i]) + coalesce(list_sum(h[1:i - 1]), 0))::BIGINT AS s FROM {kind}_p)"""


def _secrets() -> str:
    from dimflow.llm.secret_scan import RULES
    assign, access, hexes = RULES
    ctes = ",\n".join([_spans("assign", assign.pattern, assign.group), _spans("access", access.pattern),
                       _spans("hex", hexes.pattern)])
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{ctes},
spans AS (
  SELECT doc_id, 'assign' AS kind, 1 AS k, s, s + length(hit) AS e FROM assign_s WHERE length(part) >= 12
  UNION ALL SELECT doc_id, 'access', 2, s, s + length(hit) FROM access_s WHERE length(hit) >= 18
  UNION ALL SELECT doc_id, 'hex', 3, s, s + length(hit) FROM hex_s WHERE length(hit) >= 16),
g AS (
  SELECT doc_id, count(*) FILTER (k = 1) AS a, count(*) FILTER (k = 2) AS b, count(*) FILTER (k = 3) AS c,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS j FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(j, '')) AS base_sha256, coalesce(j, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


def _pii() -> str:
    from dimflow.llm.pii import CONFIDENT, CONTEXT, CONTEXT_ADDS, CONTEXT_WORDS, IBAN, PHONE, SCORES
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": PHONE,
        "iban": IBAN,
    }
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    luhn = f"""list_sum(list_transform(string_split(reverse({digits}), ''),
      lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT WHEN x::INT > 4 THEN x::INT * 2 - 9 ELSE x::INT * 2 END)) % 10 = 0"""
    bare = "replace(hit, ' ', '')"
    turned = f"(substr({bare}, 5) || substr({bare}, 1, 4))"
    mod97 = f"""list_reduce(list_prepend(0::BIGINT, list_transform(string_split({turned}, ''),
      lambda x: (CASE WHEN ascii(x) >= 65 THEN ascii(x) - 55 ELSE ascii(x) - 48 END)::BIGINT)),
      lambda r, x: (CASE WHEN x >= 10 THEN r * 100 + x ELSE r * 10 + x END) % 97) = 1"""
    keeps = {
        "email": "true",
        "ip": "len(list_filter(string_split(hit, '.'), lambda x: ltrim(x, '0') <> '' AND "
              "(length(ltrim(x, '0')) > 3 OR ltrim(x, '0')::INT > 255))) = 0",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": mod97,
    }
    ctes = ",\n".join(_spans(kind, pattern) for kind, pattern in patterns.items())
    union = "\n  UNION ALL ".join(
        f"SELECT doc_id, t, '{kind}' AS kind, {i} AS k, {SCORES[kind]} AS base, s, s + length(hit) AS e "
        f"FROM {kind}_s WHERE {keeps[kind]}" for i, kind in enumerate(patterns, 1))
    before = (f"translate(substr(t, greatest(s - {CONTEXT}, 0) + 1, s - greatest(s - {CONTEXT}, 0)), "
              f"'{UPPER}', '{LOWER}')")
    counts = ", ".join(f"count(*) FILTER (k = {i}) AS c{i}" for i in range(1, 5))
    shown = ", ".join(f"coalesce(c{i}, 0) AS n_{kind}" for i, kind in enumerate(list(patterns)[:4], 1))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{ctes},
spans AS ({union}),
scored AS (SELECT *, base + CASE WHEN regexp_matches({before}, '{CONTEXT_WORDS}') THEN {CONTEXT_ADDS} ELSE 0 END AS score
           FROM spans),
g AS (
  SELECT doc_id, {counts}, count(*) FILTER (score >= {CONFIDENT}) AS sure,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 5) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS j FROM scored GROUP BY doc_id)
SELECT d.doc_id, {shown}, sha256(coalesce(base, '')) AS base_sha256, coalesce(j, '') AS spans,
       coalesce(sure, 0) AS n_confident
FROM d LEFT JOIN g USING (doc_id)
"""


# Every window as its words; only words of repeated windows go.
SUPERKMERS = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
t AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM d),
win AS (
  SELECT rid, i, n, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS s
  FROM t),
full_win AS (SELECT rid, i, s FROM win WHERE i + 34 <= n),
rep AS (SELECT s FROM full_win GROUP BY s HAVING count(*) >= 2),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM full_win SEMI JOIN rep USING (s)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS left_words, count(*) AS n FROM t ANTI JOIN gone USING (rid, i)
         GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(left_words, '')) AS kept_sha256, len(w) > coalesce(n, 0) AS has_repeat
FROM d LEFT JOIN kept USING (rid)
"""

# Dense: every source of a language meets every kept term, as the contract words it.
DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
tok AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM tok GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
held AS (SELECT g.lang, g.source, coalesce(sum(f.n), 0) AS total FROM groups g LEFT JOIN found f USING (lang, source)
         GROUP BY ALL),
p AS (
  SELECT h.lang, h.source, k.term, coalesce(f.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 1)) // (h.total + l.v))::HUGEINT AS p,
         (1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v))::HUGEINT AS q
  FROM held h JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN found f ON f.lang = h.lang AND f.source = h.source AND f.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM every UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def _clusters(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Lloyd's rounds one after the other, all distances of all vectors."""
    ctes = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}),
x AS MATERIALIZED (SELECT rid, unnest(v) AS x, unnest(range(1, {dims + 1})) AS i FROM kept),
chosen AS MATERIALIZED (
  SELECT rid, row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1 AS cl FROM kept
  ORDER BY sha256('3:' || vec_id::VARCHAR) LIMIT {k}),
c0 AS MATERIALIZED (SELECT cl, i, x AS c FROM chosen JOIN x USING (rid))"""]
    for r in range(rounds + 1):
        ctes.append(f"""d{r} AS (SELECT rid, cl, sum((x - c) * (x - c)) AS d FROM x JOIN c{r} USING (i) GROUP BY rid, cl),
a{r} AS MATERIALIZED (SELECT rid, cl, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cl) = 1)""")
        if r < rounds:
            ctes.append(f"""s{r} AS (SELECT cl, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN x USING (rid) GROUP BY cl, i),
c{r + 1} AS MATERIALIZED (
  SELECT cl, i, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{r} LEFT JOIN s{r} USING (cl, i))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, cl::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY cl))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (rid)
JOIN (SELECT cl, sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY cl) USING (cl)
"""


ORACLE: dict[str, str] = {"op2_exact_dedup": EXACT, "op5_secret_scan": _secrets(), "op8_pii": _pii(),
                          "op11_superkmer_dedup": SUPERKMERS, "op12_source_divergence": DIVERGENCE, "op13_centroid_clustering": _clusters()}
