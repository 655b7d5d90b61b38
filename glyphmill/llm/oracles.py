"""The queries of this subpackage in DuckDB SQL, where SQL can say them. Written on their own, not derived from the operators."""

OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, i, list_slice(w, i, i + 12) AS k FROM d, unnest(range(1, len(w) - 11)) AS t(i) WHERE len(w) >= 13),
low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT r, i + j AS p FROM win JOIN low USING (k), unnest(range(13)) AS t(j) WHERE m < doc_id),
word AS (SELECT r, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS s FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
cut AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN cut USING (r)
"""

OP2 = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (SELECT r, p, l[p] AS x, regexp_matches(l[p], '[^\x20\x09-\x0D]') AS has FROM d, unnest(range(1, len(l) + 1)) AS t(p)),
num AS (SELECT r, p, x, row_number() OVER (PARTITION BY r ORDER BY p) AS i FROM line WHERE has),
win AS (SELECT r, i, [x, lead(x) OVER w, lead(x, 2) OVER w] AS k, lead(x, 2) OVER w IS NOT NULL AS whole FROM num WINDOW w AS (PARTITION BY r ORDER BY i)),
seen AS (SELECT r, i, row_number() OVER (PARTITION BY k ORDER BY r, i) > 1 AS later FROM win WHERE whole),
gone AS (SELECT DISTINCT r, i + j AS i FROM seen, unnest(range(3)) AS t(j) WHERE later),
cut AS (SELECT r, p FROM num JOIN gone USING (r, i)),
kept AS (SELECT r, string_agg(x, chr(10) ORDER BY p) AS s FROM line ANTI JOIN cut USING (r, p) GROUP BY r)
SELECT doc_id, (SELECT count(*) FROM num WHERE num.r = d.r) AS n_lines, (SELECT count(*) FROM cut WHERE cut.r = d.r) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP3 = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents, fold),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark, fold),
k AS (SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS k FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT DISTINCT len(k) AS n FROM k),
win AS (SELECT r, i, n, w[i:i + n - 1] AS k FROM d, n, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT r, i, n, item_id FROM win JOIN k USING (k)),
word AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(n)) AS t(j) GROUP BY r),
item AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)
"""

_SIZED = r"""
SELECT doc_id, text, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols,
  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS digits
FROM documents
"""

OP6 = rf"""
WITH d AS (SELECT *, -ln((digits + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) * (1 + symbols::DOUBLE / greatest(size, 1)) AS key FROM ({_SIZED})),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS up, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_w,
  coalesce(sum(3 * source_size) OVER w, 0) AS before, coalesce(sum(weight) OVER w, 0) AS before_w
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CAST(total - before AS DOUBLE) / CAST(all_w - before_w AS DOUBLE) AS level FROM o),
x AS (SELECT arg_min(level, up::DOUBLE / weight) AS level FROM l WHERE up > level * weight),
t AS (SELECT source, source_size, CASE WHEN up <= l.level * weight THEN up::DOUBLE ELSE x.level * weight END AS target FROM l, x),
e AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, target - epochs * source_size AS rest, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT doc_id, size, source_size, target, CAST((epochs + CASE WHEN 2 * (rest - before) >= size THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM p
"""

_FIGURES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM d, unnest(range(1, len(w) - 1)) AS t(i) WHERE len(w) >= 3),
rep AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM win, unnest(range(3)) AS t(j) WHERE n > 1 GROUP BY r),
f AS (SELECT r, doc_id, source, text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
v AS (SELECT *, base_failed OR 100 * n_symbols > 50 * n_words OR 100 * n_dup_lines > 50 * n_lines AS failed FROM g),
h AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS k FROM v GROUP BY source),
m AS (SELECT avg(k / n) AS m, var_pop(k / n) AS s FROM h),
b AS (SELECT m, CASE WHEN s > 0 THEN least(greatest(m * (1 - m) / s - 1, 1), 1000) ELSE 1000 END AS w FROM m),
bad AS (SELECT source, (k + m * w) / (n + w) > 0.5 AS host_rejected FROM h, b),
judged AS (SELECT v.*, host_rejected, NOT failed AND NOT host_rejected AS kept FROM v JOIN bad ON v.source IS NOT DISTINCT FROM bad.source)
"""

OP8 = _FIGURES + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"

_LEAF = "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

OP11 = rf"""
WITH RECURSIVE bit AS (SELECT n, n AS c, 0 AS k FROM range(256) AS t(n) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bit WHERE k = 8),
a AS (SELECT row_number() OVER () AS r, *, list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))) AS codes FROM documents),
b AS (SELECT *, list_reduce(codes, lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])) AS left_, doc_id IS NOT NULL AS has FROM a, crc),
leaf AS (SELECT r, doc_id, coalesce('=' || source, '-') AS k, {_LEAF.format(text="text")} AS leaf, CASE WHEN has AND xor(left_, 4294967295) % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} END AS found FROM b),
d AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM leaf),
node AS (SELECT k, 0 AS lv, i, leaf AS h, n FROM d UNION ALL SELECT k, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM node WHERE n > 1 GROUP BY k, lv, i // 3, n),
sub AS (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
over_ AS (SELECT '' AS k, 0 AS lv, i, h, n FROM sub UNION ALL SELECT k, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM over_ WHERE n > 1 GROUP BY k, lv, i // 3, n),
beside AS (SELECT a.k, a.lv, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM (SELECT * FROM node UNION ALL SELECT * FROM over_) AS a JOIN (SELECT * FROM node UNION ALL SELECT * FROM over_) AS b ON a.k = b.k AND a.lv = b.lv AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL),
up AS (SELECT r, k, 0 AS lv, i, coalesce(found, leaf) AS h, '' AS sib FROM d UNION ALL SELECT r, up.k, up.lv + 1, up.i // 3, sha256(before || h || after), sib || before || after FROM up JOIN beside USING (k, lv, i)),
at_sub AS (SELECT r, k, arg_max(h, lv) AS h, arg_max(sib, lv) AS sib FROM up GROUP BY r, k),
on_ AS (SELECT r, '' AS k, 0 AS lv, sub.i, at_sub.h, sib, sub.h AS subroot FROM at_sub JOIN sub USING (k) UNION ALL SELECT r, on_.k, on_.lv + 1, on_.i // 3, sha256(before || h || after), sib || before || after, subroot FROM on_ JOIN beside USING (k, lv, i)),
done AS (SELECT r, arg_max(subroot, lv) AS subroot, arg_max(h, lv) AS folded_root, sha256(arg_max(sib, lv)) AS proof_sha256 FROM on_ GROUP BY r),
root AS (SELECT h AS root FROM over_ WHERE n = 1)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done JOIN leaf USING (r), root
"""


def _clusters(k: int, rounds: int, dim: int) -> str:
    """Each round written out: nearest centroids, then floors of means."""
    steps = [
        f"v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v AS m FROM v QUALIFY c < {k})",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT r, min(d) AS d, arg_min(c, (d, c)) AS c FROM (SELECT r, c, CAST(list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{i}) GROUP BY r)"
        )
        if i < rounds:
            steps.append(f"p{i} AS (SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM v JOIN a{i} USING (r), range(1, {dim + 1}) AS t(j) GROUP BY c, j)")
            steps.append(f"n{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM p{i} GROUP BY c)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN n{i} USING (c))")
    last = f"SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM v JOIN a{rounds} USING (r) JOIN c{rounds} USING (c)"
    return "WITH " + ",\n".join(steps) + "\n" + last


OP12 = _clusters(8, 10, 64)

OP13 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v, coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS fine FROM embeddings),
f AS MATERIALIZED (SELECT r, CASE WHEN fine THEN v END AS v FROM v),
link AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM f AS a JOIN f AS b ON a.r <> b.r AND list_cosine_similarity(a.v, b.v) >= 0.9),
seen AS (SELECT r AS a, r AS b FROM v UNION SELECT seen.a, link.b FROM seen JOIN link ON seen.b = link.a),
low AS (SELECT a AS r, min(vec_id) AS component_id FROM seen JOIN v ON v.r = seen.b GROUP BY a),
n AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN low USING (r) LEFT JOIN n USING (r)
"""
