"""SQL for the queries it can express."""

SQL: dict[str, str] = {}

SQL["op2_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_MIXING_LEVEL = """
n{i} AS (
    SELECT {names}, CAST(sum(have) * 2 AS BIGINT) AS cap, CAST({weight} AS DOUBLE) AS weight FROM leaves GROUP BY {names}
), o{i} AS (
    SELECT n{i}.*, {parent}.budget AS parent_budget,
           row_number() OVER (PARTITION BY {above} ORDER BY cap / weight, {last}) AS place
    FROM n{i} JOIN {parent} ON {on}
), s{i} AS (
    SELECT *, (parent_budget - coalesce(sum(cap) OVER (PARTITION BY {above} ORDER BY place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (PARTITION BY {above} ORDER BY place
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
    FROM o{i}
), b{i} AS (
    SELECT {names}, least(CAST(cap AS DOUBLE), weight * max(share) OVER (PARTITION BY {above})) AS budget FROM s{i}
)"""

SQL["op4_mixing"] = rf"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '?') AS lang_, coalesce(source, '?') AS source_, lang, source,
           coalesce('domain' || CAST((instr('0123456789abcdef', md5(source)[1]) - 1) % 4 AS VARCHAR), '?') AS domain,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
    FROM documents
), leaves AS (
    SELECT domain, lang_, source_, CAST(sum(n_tokens) AS BIGINT) AS have FROM d GROUP BY domain, lang_, source_
), b0 AS (
    SELECT CAST(sum(have) AS DOUBLE) AS budget FROM leaves
), {
    _MIXING_LEVEL.format(i=1, names="domain", above="1", last="domain", parent="b0", on="true",
        weight="CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END").strip()
}, {
    _MIXING_LEVEL.format(i=2, names="domain, lang_", above="n2.domain", last="lang_", parent="b1",
        on="n2.domain = b1.domain",
        weight="CASE lang_ WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END").replace(
        "PARTITION BY n2.domain ORDER BY place", "PARTITION BY domain ORDER BY place").replace(
        "(PARTITION BY n2.domain)", "(PARTITION BY domain)").strip()
}, {
    _MIXING_LEVEL.format(i=3, names="domain, lang_, source_", above="n3.domain, n3.lang_", last="source_", parent="b2",
        on="n3.domain = b2.domain AND n3.lang_ = b2.lang_", weight="1").replace(
        "PARTITION BY n3.domain, n3.lang_ ORDER BY place", "PARTITION BY domain, lang_ ORDER BY place").replace(
        "(PARTITION BY n3.domain, n3.lang_)", "(PARTITION BY domain, lang_)").strip()
}, cut AS (
    SELECT d.*, have, budget, CAST(floor(floor(budget) / have) AS INTEGER) AS epochs
    FROM d JOIN leaves USING (domain, lang_, source_) JOIN b3 USING (domain, lang_, source_)
    WHERE have > 0
), placed AS (
    SELECT *, md5('mix-1|' || epochs || '|' || doc_id) AS place FROM cut
), run AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang_, source_ ORDER BY place) AS upto FROM placed
)
SELECT doc_id, domain, lang, source, n_tokens,
       epochs + CAST(upto <= floor(budget) - epochs * have AS INTEGER) AS copies
FROM run
WHERE epochs + CAST(upto <= floor(budget) - epochs * have AS INTEGER) > 0
"""

_CLOSEST = """
n{i} AS (
    SELECT v.vec_id, v.v, v.row, min({{'distance': CAST(list_sum(list_transform(range(1, 65), lambda j:
        (v.v[j] - c.v[j]) * (v.v[j] - c.v[j]))) AS BIGINT), 'cluster': c.cluster}}) AS near
    FROM v, c{i} AS c GROUP BY v.vec_id, v.v, v.row
)"""
_MOVED = """
s{i} AS (
    SELECT near.cluster AS cluster, j, sum(v[j]) AS total, count(*) AS n
    FROM n{i}, range(1, 65) AS r(j) GROUP BY near.cluster, j
), m{i} AS (
    SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{i} GROUP BY cluster
), c{next} AS (
    SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN m{i} AS m ON m.cluster = c.cluster
)"""

SQL["op11_centroids"] = f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
           row_number() OVER () AS row
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS INTEGER) AS cluster, v
    FROM v QUALIFY cluster < 40
), {
    ", ".join((_CLOSEST.format(i=i) + ", " + _MOVED.format(i=i, next=i + 1)).strip() for i in range(5))
}, {_CLOSEST.format(i=5).strip()}, inertias AS (
    SELECT near.cluster AS cluster, CAST(sum(near.distance) AS BIGINT) AS cluster_inertia FROM n5 GROUP BY near.cluster
)
SELECT vec_id, near.cluster AS cluster, near.distance AS distance, cluster_inertia,
       (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM inertias) AS inertia,
       sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM n5 JOIN inertias ON inertias.cluster = near.cluster JOIN c5 ON c5.cluster = near.cluster
"""


def _licenses() -> str:
    """The rules as rows, so that SQL states the same detections by joins."""
    from .licenses import BASE, GRANT_WORD, GRANTS, SURE, WIDTH, rules

    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(
        f"({n}, {quoted(r.keyword)}, {quoted(f'^{r.pattern}(?: |$)')}, {r.level}, {quoted(r.label)})" for n, r in enumerate(rules())
    )
    grants = ", ".join(map(quoted, GRANTS))
    keywords = ", ".join(map(quoted, sorted({r.keyword for r in rules()}.union(GRANTS))))
    bases = " UNION ALL ".join(
        f"SELECT doc, i AS start, {quoted(label)} AS label FROM w WHERE array_to_string(words[i+1:i+{len(p.split())}], ' ') = {quoted(p)}"
        for p, label in BASE.items()
    )
    sure = " ".join(f"WHEN {level} THEN CAST({value} AS DOUBLE)" for level, value in SURE.items())
    return f"""
WITH d AS (
    SELECT row_number() OVER () AS doc, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), w AS (
    SELECT doc, words, CAST(unnest(list_filter(range(len(words)), lambda i: words[i+1] IN ({keywords}))) AS BIGINT) AS i FROM d
), rules(rule, keyword, pattern, level, label) AS (
    VALUES {values}
), tried AS (
    SELECT doc, i, rule, level, label, rtrim(regexp_extract(array_to_string(words[i+1:i+{WIDTH}], ' '), pattern)) AS match
    FROM w JOIN rules ON keyword = CASE WHEN words[i+1] IN ({grants}) THEN {quoted(GRANT_WORD)} ELSE words[i+1] END
    WHERE level > 0
), finds AS (
    SELECT doc, i AS start, i + len(string_split(match, ' ')) AS stop, rule, level, label FROM tried WHERE match <> ''
), kept AS (
    SELECT doc, level, label FROM finds AS x
    WHERE label <> '' AND NOT EXISTS (
        SELECT 1 FROM finds AS y
        WHERE y.doc = x.doc AND y.start <= x.start AND y.stop >= x.stop
          AND (y.level < x.level OR (y.level = x.level AND (y.stop - y.start > x.stop - x.start OR y.rule < x.rule))))
), base AS ({bases}
), b AS (
    SELECT doc, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
           array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels
    FROM base GROUP BY doc
), l AS (
    SELECT doc, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
    FROM (SELECT doc, label FROM kept UNION ALL SELECT doc, label FROM base) GROUP BY doc
), s AS (
    SELECT doc, max(CASE level {sure} END) AS score FROM kept GROUP BY doc
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN b USING (doc) LEFT JOIN l USING (doc) LEFT JOIN s USING (doc)
"""


SQL["op13_licenses"] = _licenses()

# the checksum of a decimal number, bit by bit
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))))"""

SQL["op12_prefix_trie"] = f"""
WITH own AS (
    SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
    SELECT c, turns, {_CRC32} % 9 AS h FROM own
), rebuilt AS (
    SELECT h.c, CASE WHEN own.c IS NULL THEN h.turns[h + 1:] ELSE list_concat(own.turns[1:h], h.turns[h + 1:]) END AS turns
    FROM h LEFT JOIN own ON own.c = h.c - h.c % 5
), prefixes AS (
    SELECT c, CAST(unnest(range(len(turns) + 1)) AS BIGINT) AS depth, turns FROM rebuilt
), nodes AS (
    SELECT depth, turns[1:depth] AS path, min(c) AS conv_id, count(*) AS n_convs,
           max(CASE WHEN depth = 0 THEN 0 ELSE strlen(turns[depth].t) END) AS bytes,
           coalesce(string_agg(CASE WHEN len(turns) = depth THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '') AS ends
    FROM prefixes GROUP BY depth, turns[1:depth]
), children AS (
    SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), families AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, path)
), up AS (
    SELECT CAST(unnest(range(depth + 1)) AS BIGINT) AS top, path, n_children, (n_convs - 1) * bytes AS saved FROM families
), totals AS (
    SELECT top AS depth, path[1:top] AS path, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves,
           CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM up GROUP BY 1, 2
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM families AS f JOIN totals USING (depth, path)
LEFT JOIN nodes AS p ON p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]
"""

# a shingle is five words in a row, or all words of a shorter text; links reach on through links
SQL["op10_ngram_join"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
    FROM d
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM shared JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
    SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), least_ AS (
    SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_ AS l ON l.x = d.doc_id
"""
