"""DuckDB statements for the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP3 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS mixed
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INT) AS class
  FROM sized GROUP BY source),
weighed AS (SELECT *, CAST(CASE class WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS w FROM per),
totals AS (SELECT CAST(sum(s) AS BIGINT) AS all_s, CAST(sum(w) AS BIGINT) AS all_w FROM weighed),
-- a source is full if all targets at its own water level (3 s / w) fit into all words
levels AS (
  SELECT a.source, a.s, a.w, a.class,
         (SELECT sum(least(3.0 * b.s, 3.0 * a.s / a.w * b.w)) FROM weighed b) <= (SELECT all_s FROM totals) AS is_full
  FROM weighed a),
rest AS (SELECT coalesce(sum(CASE WHEN is_full THEN 3 * s END), 0) AS full_s,
                sum(CASE WHEN NOT is_full THEN w END) AS open_w FROM levels),
targets AS (
  SELECT source, s, class, CASE WHEN is_full THEN CAST(3 * s AS DOUBLE)
         ELSE CAST(CAST(w * (all_s - full_s) AS BIGINT) AS DOUBLE) / CAST(open_w AS DOUBLE) END AS target
  FROM levels, rest, totals),
placed AS (
  SELECT d.doc_id, d.size, t.s, t.class, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.mixed, d.doc_id NULLS FIRST, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
takes AS (
  SELECT *, greatest(0, least(size, goal - before)) AS t0, greatest(0, least(size, goal - before - s)) AS t1,
         greatest(0, least(size, goal - before - 2 * s)) AS t2,
         least((CAST(before AS DOUBLE) + CAST(greatest(0, least(size, goal - before)) AS DOUBLE) / 2) / target, 1.0) AS u
  FROM placed)
SELECT doc_id, size, s AS source_size, target, CAST(t0 + t1 + t2 AS BIGINT) AS taken,
       -- the time at which the integral of the class's weight reaches the share u of its total
       CASE WHEN t0 > 0 THEN round(least(greatest(CASE class
         WHEN 0 THEN 2.0 * u / (1.5 + sqrt(greatest(2.25 - 2.0 * u, 0.0)))
         WHEN 1 THEN u
         ELSE CASE WHEN u <= 0.25 / 0.875 THEN u * 0.875 / 0.5
              ELSE 0.5 + 2.0 * (u * 0.875 - 0.25) / (0.5 + sqrt(greatest(0.25 + 6.0 * (u * 0.875 - 0.25), 0.0))) END END,
         0.0), 1.0), 6) END AS first_position
FROM takes
"""


OP5 = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item, w[i : i + least(10, len(w)) - 1] AS gram
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(gram) AS l FROM grams),
texts AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
places AS (
  SELECT doc_id, l, i, w[i : i + l - 1] AS gram
  FROM (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM texts, lengths WHERE len(w) >= l)),
hits AS (SELECT p.doc_id, p.i, p.l, g.item FROM places p JOIN grams g ON p.gram = g.gram),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(item, ',' ORDER BY item) AS ids
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(a.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(b.n, 0) AS BIGINT) AS n_items, sha256(coalesce(b.ids, '')) AS items_sha256,
       coalesce(a.n, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hit_words a USING (doc_id) LEFT JOIN hit_items b USING (doc_id)
"""


def _op1() -> str:
    from churnlake.llm.licences import LINES, PHRASES, TEMPLATES, THRESHOLD, template_words

    def quoted(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    phrases = ", ".join(f"({quoted(p.split())}, '{label}')" for p, label in PHRASES)
    forms = ", ".join(f"({quoted(words)}, '{label}')" for label, words in template_words(TEMPLATES))
    return f"""
WITH phrases(p, label) AS (VALUES {phrases}),
forms(t, label) AS (VALUES {forms}),
texts AS (SELECT doc_id, {LOWER} AS lt FROM documents),
tokens AS (SELECT doc_id, regexp_extract_all(lt, '{WORD}') AS w FROM texts),
starts AS (
  SELECT doc_id, i - 1 AS place, label
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM tokens), phrases
  WHERE w[i] = p[1] AND w[i : i + len(p) - 1] = p),
base AS (SELECT doc_id, count(*) AS n, min(place) AS a, max(place) AS z FROM starts GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_transform(string_split(lt, chr(10)), lambda s: list_intersect(list_distinct(regexp_extract_all(s, '{WORD}')), kw)) AS ls
  FROM texts, (SELECT list_distinct(flatten(list(t))) AS kw FROM forms)),
-- of each run of up to {LINES} lines the words of any template
blocks AS (
  SELECT doc_id, list_distinct(flatten(ls[i : i + j - 1])) AS b
  FROM (SELECT doc_id, ls, j, unnest(generate_series(1, len(ls) - j + 1)) AS i FROM lines, generate_series(1, {LINES}) g(j))),
matches AS (
  SELECT doc_id, label, CAST(len(list_intersect(t, b)) AS DOUBLE) / len(t) AS c FROM blocks, forms WHERE len(b) >= {THRESHOLD} * len(t) - 1e-9),
best AS (SELECT doc_id, max(c) AS c FROM matches WHERE c >= {THRESHOLD} - 1e-9 GROUP BY doc_id),
base_labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS ls FROM (SELECT DISTINCT doc_id, label FROM starts) GROUP BY doc_id),
all_labels AS (
  SELECT doc_id, string_agg(label, ',' ORDER BY label) AS ls
  FROM (SELECT doc_id, label FROM starts UNION SELECT doc_id, label FROM matches WHERE c >= {THRESHOLD} - 1e-9) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
       CAST(base.a AS BIGINT) AS first_word, CAST(base.z AS BIGINT) AS last_word,
       coalesce(bl.ls, '') AS base_labels, coalesce(al.ls, '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(best.c, 0.0) END AS score
FROM tokens t LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
LEFT JOIN base_labels bl USING (doc_id) LEFT JOIN all_labels al USING (doc_id)
"""


ORACLES = {"op1_license_scan": _op1(), "op3_curriculum_mixing": OP3, "op5_benchmark_decontamination": OP5}

OP6 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, CAST(count(*) OVER (PARTITION BY x) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
"""


def _op2() -> str:
    from churnlake.llm.url_filter import CANONICAL, HREF, REFRESH, RULES, TO, TRACKING

    def sql(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rules = ", ".join(f"({sql(h)}, {sql(p)}, {sql(v)})" for h, p, v in RULES)
    tracking = TRACKING.replace("(?=&|$)", "")
    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

    def host(u: str) -> str:
        return f"coalesce(translate(regexp_extract({u}, '://([^/?#]*)', 1), {upper}), '')"

    def path(u: str) -> str:
        return f"coalesce(regexp_extract({u}, '://[^/?#]*([^?#]*)', 1), '')"

    def node(u: str) -> str:
        query = f"regexp_replace(regexp_extract({u}, '://[^?#]*(\\?[^#]*)', 1), {sql(tracking)}, '\\1', 'g')"
        query = f"regexp_replace(regexp_replace(regexp_replace({query}, '[?&]+$', ''), '\\?&+', '?'), '&&+', '&', 'g')"
        return (f"CASE WHEN contains({u}, '://') THEN {host(u)} || regexp_replace({path(u)}, '/+$', '') || {query} ELSE {u} END")

    def target(tag: str, inside: str) -> str:
        return f"regexp_extract(regexp_extract(html, {sql('(?is)' + tag)}), {sql('(?is)' + inside)}, 1)"

    return f"""
WITH RECURSIVE rules(h, p, v) AS (VALUES {rules}),
hrefs AS (
  SELECT url, unnest([{target(CANONICAL, HREF)}, {target(REFRESH, TO)}]) AS href FROM pages WHERE contains(url, '://')),
targets AS (
  SELECT url, CASE WHEN contains(href, '://') THEN href WHEN starts_with(href, '//') THEN 'http:' || href
    WHEN starts_with(href, '/') THEN 'http://' || {host('url')} || href
    ELSE 'http://' || {host('url')} || regexp_replace({path('url')}, '[^/]*$', '') || href END AS target
  FROM hrefs WHERE href <> ''),
edges AS (SELECT {node('url')} AS u, {node('target')} AS v FROM targets),
both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach(n, o) AS (
  SELECT u, u FROM both_ways UNION SELECT r.n, b.v FROM reach r JOIN both_ways b ON r.o = b.u),
comps AS (SELECT n, min(o) AS c FROM reach GROUP BY n),
urls AS (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL UNION SELECT target FROM targets),
judged AS (
  SELECT url, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS ruling
  FROM urls, rules WHERE ({host('url')} = h OR ends_with({host('url')}, '.' || h)) AND starts_with({path('url')}, p) GROUP BY url),
placed AS (SELECT u.url, coalesce(c.c, {node('u.url')}) AS component FROM urls u LEFT JOIN comps c ON c.n = {node('u.url')}),
said AS (
  SELECT component, bool_or(ruling = 'allow') AS allowed, bool_or(ruling = 'block') AS blocked
  FROM placed JOIN judged USING (url) GROUP BY component)
SELECT page_id, {host('p.url')} AS host, {path('p.url')} AS path, j.rule,
       coalesce(j.ruling, CASE WHEN s.blocked AND NOT s.allowed THEN 'block' ELSE 'allow' END) AS verdict, pl.component
FROM pages p LEFT JOIN judged j ON p.url = j.url LEFT JOIN placed pl ON p.url = pl.url LEFT JOIN said s ON pl.component = s.component
"""


ORACLES |= {"op2_redirect_equivalence": _op2(), "op6_golomb_exact_dedup": OP6}


OP12 = r"""
WITH RECURSIVE coded AS (
  SELECT doc_id, lang, text,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END) AS lowered
  FROM coded),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER () AS rid FROM hashed),
nodes(lvl, lang, idx, n, h) AS (
  SELECT 0, lang, idx, n, leaf FROM leaves
  UNION ALL
  SELECT lvl + 1, lang, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1
  GROUP BY lvl, lang, idx // 8, n),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, idx, n, h) AS (
  SELECT 0, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 8, n),
all_nodes AS (
  SELECT 0 AS part, lang, lvl, idx, n, h FROM nodes WHERE n > 1
  UNION ALL SELECT 1, NULL, lvl, idx, n, h FROM tops WHERE n > 1),
sides AS (
  SELECT part, lang, lvl, idx,
    coalesce(string_agg(h, '') OVER (PARTITION BY part, lang, lvl, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY part, lang, lvl, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM all_nodes),
-- from the leaf to its subroot, then through the tree of the subroots
low(rid, lvl, idx, folded, proof) AS (
  SELECT rid, 0, idx, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END, '' FROM (
    SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)), 4294967295::BIGINT) AS crc FROM leaves)
  UNION ALL
  SELECT w.rid, w.lvl + 1, w.idx // 8, sha256(s.l || w.folded || s.r), w.proof || s.l || s.r
  FROM low w JOIN leaves v ON v.rid = w.rid JOIN sides s ON s.part = 0 AND s.lang IS NOT DISTINCT FROM v.lang AND s.lvl = w.lvl AND s.idx = w.idx),
ends AS (SELECT rid, arg_max(folded, lvl) AS folded, arg_max(proof, lvl) AS proof FROM low GROUP BY rid),
high(rid, lvl, idx, folded, proof) AS (
  SELECT v.rid, 0, b.idx, e.folded, e.proof FROM ends e JOIN leaves v ON v.rid = e.rid JOIN subroots b ON b.lang IS NOT DISTINCT FROM v.lang
  UNION ALL
  SELECT w.rid, w.lvl + 1, w.idx // 8, sha256(s.l || w.folded || s.r), w.proof || s.l || s.r
  FROM high w JOIN sides s ON s.part = 1 AND s.lvl = w.lvl AND s.idx = w.idx),
done AS (SELECT rid, arg_max(folded, lvl) AS folded, arg_max(proof, lvl) AS proof FROM high GROUP BY rid),
root AS (SELECT h FROM tops WHERE n = 1)
SELECT v.doc_id, v.leaf, b.h AS subroot, root.h AS root, sha256(d.proof) AS proof_sha256, d.folded AS folded_root,
       d.folded = root.h AS verified
FROM leaves v JOIN subroots b ON b.lang IS NOT DISTINCT FROM v.lang JOIN done d ON d.rid = v.rid, root
"""


ORACLES["op12_merkle_manifest"] = OP12


def _op13(dimensions: int = 64, centroids: int = 16, rounds: int = 3) -> str:
    distance = f"list_sum(list_transform(generate_series(1, {dimensions}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    parts = [f"""
v AS (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda e: CAST(floor({dimensions} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dimensions}),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id NULLS FIRST, x) - 1 AS k, x FROM v
  QUALIFY k < {centroids})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS (
  SELECT v.rid, arg_min(c.k, ({distance}, c.k)) AS k, CAST(min({distance}) AS BIGINT) AS d FROM v, c{r} c GROUP BY v.rid)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (
  SELECT k, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (
    SELECT a.k, i, CAST(sum(v.x[i]) AS DECIMAL(38, 10)) AS s, count(*) AS n
    FROM a{r} a JOIN v USING (rid), generate_series(1, {dimensions}) g(i) GROUP BY a.k, i) GROUP BY k),
c{r + 1} AS (SELECT c.k, coalesce(s.x, c.x) AS x FROM c{r} c LEFT JOIN s{r} s USING (k))""")
    return f"""
WITH {",".join(parts)}
SELECT v.vec_id, CAST(a.k AS INT) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (rid) JOIN c{rounds} c ON c.k = a.k
"""


ORACLES["op13_incremental_clusters"] = _op13()
