"""DuckDB SQL of the queries that SQL can express, over the given tables."""

from __future__ import annotations

from . import license_scan, license_texts, mixing, personal_data, secret_scan, url_filter
from .common import LOWER, UPPER, WORD


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(expr: str) -> str:
    c = f"regexp_replace(translate(coalesce({expr}, ''), '{UPPER}', '{LOWER}'), {_q(license_scan.COPYRIGHT_LINE)}, ' ', 'g')"
    c = f"(' ' || regexp_replace({c}, {_q(license_scan.OTHER)}, '  ', 'g') || ' ')"
    for pattern, word in license_texts.EQUIVALENT:
        c = f"regexp_replace({c}, {_q(pattern)}, {_q(word.replace('$', chr(92)))}, 'g')"
    return f"trim(regexp_replace({c}, ' +', ' ', 'g'), ' ')"


def licenses() -> str:
    known = ", ".join(f"({_q(n)}, {_q(t)})" for n, t in license_texts.KNOWN)
    return f"""
WITH forms AS (SELECT name, {_canonical('body')} AS form FROM (VALUES {known}) v(name, body)),
known AS (SELECT sha256(form) AS digest, min(name) AS license_id FROM forms WHERE form <> '' GROUP BY 1),
whole AS (SELECT doc_id, sha256({_canonical('text')}) AS canonical_sha256 FROM documents),
parts AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
found AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids
          FROM (SELECT doc_id, sha256({_canonical('line')}) AS digest FROM parts) JOIN known USING (digest) GROUP BY 1)
SELECT w.doc_id, w.canonical_sha256, k.license_id, coalesce(f.n, 0)::BIGINT AS n_license_lines,
       coalesce(f.ids, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.canonical_sha256 = k.digest LEFT JOIN found f ON w.doc_id = f.doc_id"""


def mix(evenness: float = 0.5, repeat_limit: float = 4.0, block_rows: int = 1024, seed: int = 0) -> str:
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(len(regexp_extract_all(text, {_q(WORD)})), 0)::BIGINT AS n_tokens,
         md5('{seed}|' || coalesce(doc_id::VARCHAR, '')) AS ord FROM documents),
src AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*)::BIGINT AS n_rows FROM docs GROUP BY 1),
live AS (SELECT list(tokens) AS t, sum(tokens)::DOUBLE AS total, count(*) AS n FROM src WHERE tokens > 0),
nat AS (SELECT *, list_transform(t, lambda x: x / total) AS p FROM live),
tgt AS (SELECT *, (1 - {evenness}) * -list_sum(list_transform(p, lambda x: x * ln(x))) + {evenness} * ln(n) AS goal FROM nat),
bis(i, lo1, hi1, lo2, hi2) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN e THEN lo1 ELSE m1 END, CASE WHEN e THEN m1 ELSE hi1 END,
         CASE WHEN r THEN lo2 ELSE m2 END, CASE WHEN r THEN m2 ELSE hi2 END
  FROM (SELECT i, lo1, hi1, lo2, hi2, m1, m2,
          ln(list_sum(list_transform(p, lambda x: pow(x, m1))))
            - m1 * list_sum(list_transform(p, lambda x: pow(x, m1) * ln(x))) / list_sum(list_transform(p, lambda x: pow(x, m1))) <= goal AS e,
          list_max(list_transform(t, lambda x: pow(x / total, m2) / x)) * total / list_sum(list_transform(p, lambda x: pow(x, m2))) <= {repeat_limit} AS r
        FROM (SELECT *, (lo1 + hi1) / 2 AS m1, (lo2 + hi2) / 2 AS m2 FROM bis WHERE i < 42), tgt)),
expo AS (SELECT greatest(hi1, hi2) AS a FROM bis WHERE i = 42),
goals AS (SELECT source, tokens, ceil(n_rows / {block_rows}) AS n_blocks,
            CASE WHEN tokens > 0 THEN pow(tokens / total, a) / list_sum(list_transform(p, lambda x: pow(x, a))) ELSE 0 END AS weight, total
          FROM src, expo, tgt),
want AS (SELECT *, floor(weight * total)::BIGINT AS goal FROM goals),
dealt AS (SELECT d.*, w.weight, w.tokens, w.goal,
            floor(('0x' || substr(ord, 1, 8))::BIGINT * n_blocks / 4294967296)::BIGINT AS block FROM docs d JOIN want w USING (source)),
blocks AS (SELECT source, block, sum(n_tokens) AS bt FROM dealt GROUP BY 1, 2),
ranked AS (SELECT source, block, row_number() OVER w AS block_rank, sum(bt) OVER (w ROWS UNBOUNDED PRECEDING) - bt AS before FROM blocks
           WINDOW w AS (PARTITION BY source ORDER BY md5('{seed}|' || source || '|' || block))),
placed AS (SELECT *, before + sum(n_tokens) OVER (PARTITION BY source, block ORDER BY ord, doc_id ROWS UNBOUNDED PRECEDING) AS upto
           FROM dealt JOIN ranked USING (source, block))
SELECT doc_id, source, n_tokens, round(weight, 6) AS weight,
       CASE WHEN n_tokens > 0 THEN goal // tokens + (upto <= goal % tokens)::INT ELSE 0 END::BIGINT AS copies,
       block, block_rank::BIGINT AS block_rank, (upto - n_tokens)::BIGINT AS "offset"
FROM placed"""


def secrets() -> str:
    parts = []
    for i, r in enumerate(secret_scan.RULES):
        p = _q(r.pattern)
        parts.append(f"""
  SELECT doc_id, {i} AS rule, '{r.kind}' AS kind, e - length(hit) AS s, e FROM (
    SELECT doc_id, hits[i] AS hit, secrets[i] AS secret, (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + list_sum(list_transform(hits[1:i], lambda x: length(x))))::BIGINT AS e
    FROM (SELECT doc_id, gaps, hits, secrets, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT doc_id, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}, 0) AS hits,
             regexp_extract_all(text, {p}, {r.group}) AS secrets FROM documents WHERE regexp_matches(text, {p}))))
  WHERE length(secret) >= {r.least}""")
    base = secret_scan.BASE
    line = "kind || ':' || s || ':' || e, ',' ORDER BY s, rule"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.RULES[:base])
    outs = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in secret_scan.RULES[:base])
    return f"""
WITH spans AS ({' UNION ALL '.join(parts)}),
found AS (SELECT doc_id, {counts}, string_agg({line}) FILTER (rule < {base}) AS first, string_agg({line}) AS spans FROM spans GROUP BY 1)
SELECT doc_id, {outs}, sha256(coalesce(first, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN found USING (doc_id)"""


EXACT_DEDUP = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM t JOIN g USING (text)"""


def urls(order: int = url_filter.ORDER) -> str:
    low = lambda e: f"translate({e}, '{UPPER}', '{LOWER}')"
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r.rule), r.rule))
    fit = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    case = lambda what: "CASE " + " ".join(f"WHEN {fit(r)} THEN '{getattr(r, what)}'" for r in rules) + " END"
    models, prev = "", "SELECT gram, 1.0::DOUBLE / 256 AS pa, 1.0::DOUBLE / 256 AS pb FROM wanted"
    for k in range(order + 1):
        models += f"""
o{k} AS (SELECT substr(gram, {order - k + 1}, {k + 1}) AS tail, sum(na) AS na, sum(nb) AS nb FROM counts GROUP BY 1),
c{k} AS (SELECT substr(tail, 1, {k}) AS ctx, sum(na) AS ta, sum(nb) AS tb, sum((na > 0)::INT) AS ka, sum((nb > 0)::INT) AS kb FROM o{k} GROUP BY 1),
p{k} AS (SELECT gram, CASE WHEN ta > 0 THEN (coalesce(na, 0) + ka * pa) / (ta + ka) ELSE pa END AS pa,
           CASE WHEN tb > 0 THEN (coalesce(nb, 0) + kb * pb) / (tb + kb) ELSE pb END AS pb
         FROM ({prev}) LEFT JOIN o{k} ON tail = substr(gram, {order - k + 1}, {k + 1}) LEFT JOIN c{k} ON ctx = substr(gram, {order - k + 1}, {k})),"""
        prev = f"SELECT * FROM p{k}"
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
r0 AS (SELECT page_id, {low("regexp_extract(url, '://([^/?#]*)', 1)")} AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path,
         {low("CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)://(.*)', 1) ELSE url END")} AS body FROM u),
r AS (SELECT *, {case('rule')} AS rule, {case('verdict')} AS fixed FROM r0),
urls AS (SELECT body, max(fixed) AS label, ('0x' || substr(md5(body), 1, 4))::INT % 5 AS fold FROM r GROUP BY 1),
g AS (SELECT body, label, fold, substr(repeat(chr(2), {order}) || body, i, {order + 1}) AS gram
      FROM (SELECT *, unnest(range(1, length(body) + 1)) AS i FROM urls)),
counts AS (SELECT gram, count(*) FILTER (label = 'allow') AS na, count(*) FILTER (label = 'block') AS nb
           FROM g WHERE label IS NOT NULL AND fold > 0 GROUP BY 1),
wanted AS (SELECT DISTINCT gram FROM g),{models}
scores AS (SELECT urls.body, any_value(urls.label) AS label, any_value(urls.fold) AS fold,
             coalesce(sum(ln(pa) - ln(pb)) / count(pa), 0) AS ratio FROM urls LEFT JOIN g ON g.body = urls.body LEFT JOIN p{order} USING (gram) GROUP BY 1),
cells AS (SELECT floor(greatest(-8.0, least(8.0, ratio)) / 0.01)::BIGINT AS cell, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b
          FROM scores WHERE label IS NOT NULL AND fold = 0 GROUP BY 1),
errs AS (SELECT cell, sum(a) OVER w / (SELECT sum(a) FROM cells) + 1 - sum(b) OVER w / (SELECT sum(b) FROM cells) AS error
         FROM cells WINDOW w AS (ORDER BY cell ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT CASE WHEN (SELECT least(sum(a), sum(b)) FROM cells) > 0
          THEN 0.01 * coalesce((SELECT cell + 1 FROM errs WHERE error < 1 ORDER BY error, cell LIMIT 1), (SELECT min(cell) FROM cells)) ELSE 0 END AS cut)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN ratio < cut AND length(r.body) > 0 THEN 'block' ELSE 'allow' END) AS verdict,
       round(ratio, 6) AS ratio
FROM r JOIN scores ON scores.body = r.body, cut"""


def _crc32(expr: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    bits = f"list_transform(range(8 * length({expr})), lambda k: (ascii(substr({expr}, (k // 8 + 1)::BIGINT, 1))::BIGINT >> (k % 8)) & 1)"
    step = "CASE WHEN (c & 1) <> b THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: {step}), 4294967295)"


PERIODIC_RUNS = f"""
WITH t AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_q(WORD)}), []) AS ws, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
a AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a, 3 + (h // 10) % 8 AS m FROM t),
u AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE
        list_transform(range(n), lambda i: ws[(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // m) END)::BIGINT]) END AS ws FROM a),
x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(ws) AS w FROM u),
same AS (SELECT a.doc_id, a.i, a.i - b.i AS q FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.w = b.w AND b.i < a.i AND 4 * (a.i - b.i) <= a.n),
stretch AS (SELECT doc_id, q, min(i) - q AS s, count(*) + q AS len
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same)
            GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, len, min(q) AS q FROM stretch GROUP BY 1, 2, 3),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS body FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
            list([s, len, q] ORDER BY len / q DESC, s, q)[1] AS best FROM runs GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1]::BIGINT AS "start", best[2]::BIGINT AS length, best[3]::BIGINT AS period,
       (1000 * best[2] // best[3])::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(body, '')) AS collapsed_sha256
FROM documents LEFT JOIN found USING (doc_id) LEFT JOIN kept USING (doc_id)"""


HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10"""


def personal(rounds: int = 8) -> str:
    kinds, n_votes, shapes = personal_data.KINDS, personal_data.VOTES, personal_data.SHAPES
    found = " UNION ALL ".join(f"""
  SELECT row, {i} AS k, '{k.name}' AS kind, {extra} AS extra, hits[i] AS hit, right(gaps[i], {personal_data.BEFORE}) AS before,
         left(gaps[i + 1], {personal_data.AFTER}) AS after, (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + list_sum(list_transform(hits[1:i], lambda x: length(x))))::BIGINT AS e
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT row, string_split_regex(text, {_q(p)}) AS gaps, regexp_extract_all(text, {_q(p)}, 0) AS hits FROM d WHERE regexp_matches(text, {_q(p)})))"""
                              for i, k in enumerate(kinds) for extra, p in ((False, k.base), (True, k.extra)))
    subject = {"valid": "ok::VARCHAR", "before": f"translate(before, '{UPPER}', '{LOWER}')"}
    votes = ", ".join("CASE kind " + " ".join(
        f"WHEN '{k.name}' THEN CASE WHEN regexp_matches({subject.get(x.subject, x.subject)}, {_q(x.against)}) THEN -1 "
        f"WHEN regexp_matches({subject.get(x.subject, x.subject)}, {_q(x.favour)}) THEN 1 ELSE 0 END"
        for k in kinds for x in [k.labelers[j]]) + f" END AS v{j}" for j in range(n_votes))
    vs = ", ".join(f"v{j}" for j in range(n_votes))
    long = lambda rel, key, names: " UNION ALL ".join(f"SELECT {key}, kind, n, '{x}' AS name, {x}::VARCHAR AS value FROM {rel}" for x in names)
    fit = lambda to, rel, key, odds: f"""
{to}w AS (SELECT kind, name, value, sum(n * p) AS yes, sum(n * (1 - p)) AS no
          FROM {rel} JOIN (SELECT {key}, 1 / (1 + exp(-odds)) AS p FROM {odds}) USING ({key}) GROUP BY 1, 2, 3),
{to}m AS (SELECT kind, name, value, ln((yes + count(*) OVER g * (yes + no) / (sum(yes + no) OVER g)) / (sum(yes) OVER g + count(*) OVER g))
              - ln((no + count(*) OVER g * (yes + no) / (sum(yes + no) OVER g)) / (sum(no) OVER g + count(*) OVER g)) AS o,
            ln((sum(yes) OVER g + 1) / (sum(no) OVER g + 1)) AS prior FROM {to}w WINDOW g AS (PARTITION BY kind, name)),
{to} AS MATERIALIZED (SELECT {key}, sum(o) + max(prior) AS odds FROM {rel} JOIN {to}m USING (kind, name, value) GROUP BY 1),"""  # noqa: E731
    rounds_sql = "".join(fit(f"p{r}", "pat_long", "pid", f"p{r - 1}") for r in range(1, rounds + 1))
    names = [f"v{j}" for j in range(n_votes)] + [f"f_{n}" for n in shapes]
    counts = ", ".join(f"count(*) FILTER (base AND kind = '{k.name}') AS n_{k.name}" for k in kinds)
    outs = ", ".join(f"coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}" for k in kinds)
    line = "kind || ':' || s || ':' || e, ',' ORDER BY k, s"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
forms AS (SELECT *, e - length(hit) AS s, regexp_replace(hit, '[^0-9]', '', 'g') AS digits, right(before, 1) || '~' || after AS edge,
  CASE WHEN kind = 'email' THEN regexp_replace(regexp_replace(hit, ' ?[\\[(]at[\\])] ?', '@', 'g'), ' ?([\\[(]dot[\\])]|\\.) ?', '.', 'g') ELSE hit END AS plain FROM found),
checked AS (SELECT *, CASE kind
    WHEN 'ip' THEN extra OR len(list_filter(string_split(hit, '.'), lambda x: ltrim(x, '0') <> '' AND (length(ltrim(x, '0')) > 3 OR TRY_CAST(x AS BIGINT) > 255))) = 0
    WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(digits)), lambda i:
      CASE WHEN i % 2 = 0 THEN reverse(digits)[(i + 1)::BIGINT]::INT ELSE (2 * reverse(digits)[(i + 1)::BIGINT]::INT) // 10 + (2 * reverse(digits)[(i + 1)::BIGINT]::INT) % 10 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15 ELSE true END AND NOT (extra AND regexp_matches(edge, '[0-9]')) AS ok FROM forms),
cand AS MATERIALIZED (SELECT row_number() OVER () AS cid, row, k, kind, extra, ok, s, e, {votes},
    {", ".join(f"{x} AS f_{n}" for n, x in shapes.items())}, 1 AS n
  FROM checked WHERE kind <> 'card' OR ok OR extra OR length(digits) >= {personal_data.LEAST_DIGITS}),
pat AS MATERIALIZED (SELECT *, row_number() OVER () AS pid FROM (SELECT kind, {vs}, count(*) AS n FROM cand GROUP BY ALL)),
pat_long AS MATERIALIZED ({long("pat", "pid", [f"v{j}" for j in range(n_votes)])}),
p0 AS (SELECT pid, {" + ".join(f"{w} * v{j}" for j, w in enumerate(personal_data.FIRST_WEIGHTS))} AS odds FROM pat),{rounds_sql}
first AS (SELECT cid, odds FROM cand JOIN pat USING (kind, {vs}) JOIN p{rounds} USING (pid)),
cand_long AS MATERIALIZED ({long("cand", "cid", names)}),{fit("last", "cand_long", "cid", "first")}
spans AS (SELECT *, NOT extra AND ok AS base FROM cand LEFT JOIN last USING (cid) WHERE ok AND (NOT extra OR odds > 0)),
free AS (SELECT *, base OR (coalesce(max(e) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= s
    AND coalesce(min(CASE WHEN base THEN s END) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), e) >= e) AS stays
  FROM spans WINDOW w AS (PARTITION BY row ORDER BY s, base DESC, e DESC, kind)),
lists AS (SELECT row, {counts}, string_agg({line}) FILTER (base) AS first, string_agg({line}) AS spans, count(*) FILTER (NOT base) AS n_added
          FROM free WHERE stays GROUP BY 1)
SELECT doc_id, {outs}, sha256(coalesce(first, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_added, 0)::BIGINT AS n_added
FROM d LEFT JOIN lists USING (row)"""


ORACLE = {"op1_license_scan": licenses(), "op4_mix_sources": mix(), "op7_secret_scan": secrets(),
          "op9_exact_dedup": EXACT_DEDUP, "op10_url_filter": urls(),
          "op11_hard_negatives": HARD_NEGATIVES, "op12_personal_data": personal(), "op13_periodic_runs": PERIODIC_RUNS}
