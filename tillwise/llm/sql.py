"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM sources
), weighed AS (
    SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS cap, (SELECT sum(source_size) FROM sources) AS everything FROM ranked
), shares AS (
    SELECT *, (everything - coalesce(sum(cap) OVER before, 0))::DOUBLE / (sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share
    FROM weighed WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT rank, source, source_size, least(cap::DOUBLE, (SELECT max(share) FROM shares) * weight) AS target,
        greatest(1, least(64, everything // 65536))::BIGINT AS block, everything FROM shares
), seats AS (
    SELECT *, floor(everything / block + 0.5)::BIGINT AS n FROM targets
), source_wins AS (
    SELECT rank, j FROM (
        SELECT rank, j, n, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, rank, j) AS place
        FROM seats, (SELECT unnest(range(0, (SELECT max(n) FROM seats))) AS j)
        WHERE j <= 2 + 1.5 * n * target / nullif(everything, 0) + (SELECT count(*) FROM seats)
    ) WHERE place <= n
), source_quota AS (
    SELECT s.*, (SELECT count(*) FROM source_wins w WHERE w.rank = s.rank) AS quota,
        greatest(1, ceil(source_size / 16384.0))::BIGINT AS shards FROM seats s
), dealt AS (
    SELECT d.doc_id, d.size, q.rank, q.source_size, q.target, q.block, md5('mix:' || coalesce(d.doc_id::VARCHAR, '')) AS seeded,
        ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT % q.shards AS shard
    FROM sized d JOIN source_quota q ON d.source IS NOT DISTINCT FROM q.source
), shard_words AS (
    SELECT rank, shard, any_value(block) AS block, sum(size)::BIGINT AS words FROM dealt GROUP BY rank, shard
), shard_wins AS (
    SELECT rank, shard, count(*) AS quota FROM (
        SELECT s.rank, s.shard, q.quota, row_number() OVER (PARTITION BY s.rank ORDER BY s.words::DOUBLE / (2 * j + 1) DESC, s.shard, j) AS place
        FROM shard_words s JOIN source_quota q USING (rank), (SELECT unnest(range(0, (SELECT max(quota) FROM source_quota))) AS j)
        WHERE j < q.quota
    ) WHERE place <= quota GROUP BY rank, shard
), budgets AS (
    SELECT s.*, least(coalesce(w.quota, 0) * block, 3 * words) AS budget
    FROM shard_words s LEFT JOIN shard_wins w USING (rank, shard) WHERE words > 0
), blocks AS (
    SELECT rank, shard, k, least(block, words - k * block) AS length, budget % words AS rest,
        md5('mix:' || rank || ':' || shard || ':' || k) AS seeded
    FROM budgets, LATERAL (SELECT unnest(range(0, (words - 1) // block + 1)) AS k)
), drawn AS (
    SELECT rank, shard, k, greatest(0, least(length, rest - (sum(length) OVER (PARTITION BY rank, shard ORDER BY seeded) - length))) AS chosen FROM blocks
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY rank, shard ORDER BY seeded, doc_id, size) AS place,
        sum(size) OVER (PARTITION BY rank, shard ORDER BY seeded, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
    FROM dealt
), extra AS (
    SELECT p.rank, p.shard, p.place, sum(greatest(0, least(p.start + p.size, d.k * p.block + d.chosen) - greatest(p.start, d.k * p.block))) AS words
    FROM placed p JOIN drawn d ON p.rank = d.rank AND p.shard = d.shard AND d.chosen > 0
        AND d.k * p.block < p.start + p.size AND d.k * p.block + d.chosen > p.start
    GROUP BY ALL
)
SELECT p.doc_id, p.size, p.source_size, p.target, (p.size * coalesce(b.budget // b.words, 0) + coalesce(e.words, 0))::BIGINT AS taken
FROM placed p LEFT JOIN budgets b USING (rank, shard) LEFT JOIN extra e USING (rank, shard, place)
"""

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, md5(text) AS text_hash, unnest(string_split(text, chr(10))) AS line,
        unnest(range(0, len(string_split(text, chr(10))))) AS pos
    FROM documents WHERE text IS NOT NULL
), windows AS (
    SELECT l.doc_id, l.text_hash, l.pos, [l.line, m.line, n.line] AS w
    FROM lines l JOIN lines m ON m.doc_id = l.doc_id AND m.text_hash = l.text_hash AND m.pos = l.pos + 1
        JOIN lines n ON n.doc_id = l.doc_id AND n.text_hash = l.text_hash AND n.pos = l.pos + 2
    WHERE regexp_matches(l.line || m.line || n.line, '[^ 	-
]')
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, text_hash, pos) AS nth FROM windows
), gone AS (
    SELECT DISTINCT doc_id, text_hash, pos + k AS pos FROM ordered, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1
), cleaned AS (
    SELECT doc_id, text_hash, count(*) AS n_lines, count(g.pos) AS n_removed,
        coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
    FROM lines l LEFT JOIN gone g USING (doc_id, text_hash, pos) GROUP BY doc_id, text_hash
)
SELECT d.doc_id, c.text, coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(c.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN cleaned c ON c.doc_id = d.doc_id AND c.text_hash = md5(d.text)
"""

HOST_REPUTATION = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), urls AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), numbered AS (
    SELECT *, try_cast(regexp_extract(path, '^/[^/]*/([0-9]{1,18})([^0-9]|$)', 1) AS BIGINT) AS doc_id FROM urls
), outcomes AS (
    SELECT page_id, min((quality = 1 AND toxic = 0)::INT) AS good FROM numbered JOIN labels USING (doc_id)
    WHERE (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY page_id
), hosts AS (
    SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
        count(good)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS k
    FROM urls LEFT JOIN outcomes USING (page_id) GROUP BY host
), domains AS (
    SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix
), levels AS (
    SELECT 'host' AS level, domain AS parent, n, k FROM hosts UNION ALL SELECT 'domain', suffix, n, k FROM domains
    UNION ALL SELECT 'suffix', '', n, k FROM suffixes
), parents AS (
    SELECT level, parent, sum(n) AS n, sum(k) AS k, count(*) AS j, sum(k * k / n) AS q, sum(n * n) AS m
    FROM levels WHERE n > 0 GROUP BY level, parent
), sums AS (
    SELECT level, sum(n) AS n, sum(k) AS k, sum(j - 1) AS df, sum(q - k * k / n) AS s, sum(m / n) AS m, sum(k) / sum(n) * (1 - sum(k) / sum(n)) AS noise
    FROM parents GROUP BY level
), rhos AS (
    SELECT level, (s - noise * df) / nullif(noise * (n - m - df), 0) AS rho FROM sums
), strengths AS (
    SELECT level, greatest(1, least(10000, CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE 10000 END)) AS strength FROM rhos
), suffix_rates AS (
    SELECT suffix, (k + strength * (SELECT sum(k) / sum(n) FROM suffixes)) / (n + strength) AS rate
    FROM suffixes, strengths WHERE level = 'suffix'
), domain_rates AS (
    SELECT domain, suffix, (k + strength * rate) / (n + strength) AS rate
    FROM domains JOIN suffix_rates USING (suffix), strengths WHERE level = 'domain'
), posterior AS (
    SELECT host, k + strength * rate AS a, n - k + strength * (1 - rate) AS b
    FROM hosts JOIN domain_rates USING (domain, suffix), strengths WHERE level = 'host'
), bounds AS (
    SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
    SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM urls u JOIN bounds USING (host) LEFT JOIN fitting f USING (page_id)
"""

_ASSIGNED = """
), apart{r} AS (
    SELECT p.row, c.cluster, sum((p.x - c.x) * (p.x - c.x)) AS distance FROM parts p JOIN centroids{r} c USING (dim) GROUP BY ALL
), assigned{r} AS (
    SELECT row, min(distance) AS distance, arg_min(cluster, distance * 16 + cluster) AS cluster FROM apart{r} GROUP BY row"""

_MOVED = """
), centroids{next} AS (
    SELECT c.cluster, c.dim, coalesce(m.x, c.x) AS x FROM centroids{r} c LEFT JOIN (
        SELECT cluster, dim, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS x
        FROM parts JOIN assigned{r} USING (row) GROUP BY cluster, dim
    ) m USING (cluster, dim)"""

CENTROIDS = (
    """
WITH kept AS (
    SELECT vec_id, embedding, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), embedding) AS row FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), parts AS (
    SELECT row, unnest(range(64)) AS dim, floor(64 * unnest(embedding)::DOUBLE)::HUGEINT AS x FROM kept
), centroids0 AS (
    SELECT row - 1 AS cluster, dim, x FROM parts WHERE row <= 16"""
    + "".join(_ASSIGNED.format(r=r) + _MOVED.format(r=r, next=r + 1) for r in range(3))
    + _ASSIGNED.format(r=3)
    + """
), digests AS (
    SELECT cluster, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM centroids3 GROUP BY cluster
)
SELECT vec_id, cluster::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM kept JOIN assigned3 USING (row) JOIN digests USING (cluster)
"""
)

INTERPLAY = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), firsts AS (
    SELECT coalesce(text, '') AS text, min(doc_id) AS first FROM documents GROUP BY ALL
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), docs AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        MAP {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
            'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
            'E': coalesce(doc_id > first, false)} AS fails
    FROM cut JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)
), groups AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
    SELECT '' AS filter_order UNION ALL SELECT filter_order || letter FROM orders, letters WHERE position(letter IN filter_order) = 0
), steps AS (
    SELECT filter_order, step::INT AS step, filter_order[step] AS letter, string_split(filter_order[:step - 1], '') AS earlier
    FROM orders, range(1, 6) AS r(step) WHERE length(filter_order) = 5
), counted AS (
    SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (WHERE fails[letter] AND NOT list_bool_or(list_transform(earlier, lambda x: coalesce(fails[x], false)))), 0) AS removed,
        coalesce(sum(n) FILTER (WHERE fails[letter] AND list_bool_or(list_transform(earlier, lambda x: coalesce(fails[x], false)))), 0) AS redundant,
        coalesce(sum(n) FILTER (WHERE NOT fails[letter] AND NOT list_bool_or(list_transform(earlier, lambda x: coalesce(fails[x], false)))), 0) AS kept,
        coalesce(sum(n) FILTER (WHERE fails[letter] AND len(list_filter(map_values(fails), lambda x: x)) = 1), 0) AS unique_fails,
        coalesce(sum(good) FILTER (WHERE fails[letter] AND NOT list_bool_or(list_transform(earlier, lambda x: coalesce(fails[x], false)))), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE fails[letter] AND NOT list_bool_or(list_transform(earlier, lambda x: coalesce(fails[x], false)))), 0) AS toxic_lost
    FROM groups, steps GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), runs AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM cut WHERE len(words) > 0)
), sized AS (
    SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
    FROM runs a JOIN runs b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM common JOIN sized a ON u = a.doc_id JOIN sized b ON v = b.doc_id WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), reach AS (
    SELECT doc_id AS u, doc_id AS v FROM documents UNION
    SELECT r.u, l.v FROM reach r JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) l ON r.v = l.u
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(v) AS component_id, doc_id = min(v) AS kept
FROM reach JOIN documents ON u = doc_id LEFT JOIN sized USING (doc_id) GROUP BY doc_id
"""

ORACLE = {
    "op1_mixing": MIXING, "op3_line_dedup": LINE_DEDUP, "op10_host_reputation": HOST_REPUTATION, "op11_interplay": INTERPLAY,
    "op12_lsh_forest": NEAR_DUPLICATES, "op13_centroids": CENTROIDS,
}
