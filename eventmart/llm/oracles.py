"""DuckDB SQL for the queries that SQL can express."""

EXACT_DEDUP = r"""
    SELECT doc_id, min(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
           doc_id IS NOT DISTINCT FROM min(doc_id) OVER copies AS kept, text_sha256
    FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g')) AS text_sha256
          FROM documents)
    WINDOW copies AS (PARTITION BY text_sha256)"""

# Steps of the mix over a relation `sized` (doc_id, source, size, shuffle_key).
MIX_STEPS = """
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (
        SELECT source, source_size, 3 * source_size AS ceiling,
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
        FROM totals),
    filled AS (
        SELECT *, CAST(ceiling AS DOUBLE) / weight AS ratio,
               row_number() OVER fill AS place,
               CAST(sum(source_size) OVER () - coalesce(sum(ceiling) OVER before, 0) AS DOUBLE)
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
        FROM weighed
        WINDOW fill AS (ORDER BY CAST(ceiling AS DOUBLE) / weight, source NULLS LAST),
               before AS (ORDER BY CAST(ceiling AS DOUBLE) / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    targets AS (
        SELECT source, source_size,
               least(CAST(ceiling AS DOUBLE),
                     (SELECT arg_min(level, place) FROM filled WHERE ratio >= level) * weight) AS target
        FROM filled),
    queued AS (
        SELECT s.*, t.source_size, t.target,
               sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle_key, s.doc_id, s.size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS served
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    copies AS (
        SELECT doc_id, size, shuffle_key, pass, (served + source_size * pass) / target AS finish
        FROM queued, range(3) p(pass) WHERE target > 0),
    ordered AS (
        SELECT *, sum(size) OVER (ORDER BY finish, shuffle_key, doc_id, pass ROWS UNBOUNDED PRECEDING) AS running
        FROM copies),
    counted AS (
        SELECT doc_id, size, count(*) FILTER (running <= (SELECT sum(size) FROM sized)) AS times
        FROM ordered GROUP BY doc_id, size)"""

SIZED = r"""
    sized AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) AS BIGINT) AS size,
               md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle_key
        FROM documents)"""

SOURCE_MIX = f"""
    WITH {SIZED}, {MIX_STEPS}
    SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(c.times, 0) AS BIGINT) AS taken
    FROM queued q LEFT JOIN counted c ON q.doc_id = c.doc_id AND q.size = c.size"""

CHAT_FORMAT = r"""
    WITH spoken AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
    escaped AS (
        SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS safe_text,
               replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ': ', '\: ') AS safe_role
        FROM spoken)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(safe_role) + length(safe_text) + 14) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id"""

FILTER_AUDIT = r"""
    WITH words AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS words FROM documents),
    firsts AS (SELECT text, min(doc_id) AS first_id FROM words GROUP BY text),
    marks AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
              FROM labels GROUP BY doc_id),
    judged AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
               || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN first_id IS NOT NULL AND coalesce(doc_id > first_id, true) THEN 'E' ELSE '' END AS fails
        FROM words JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
    counts AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
        JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
    steps AS (
        SELECT filter_order, step, filter_order[step] AS filter, filter_order[1:step - 1] AS earlier
        FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders)),
    met AS (
        SELECT part, filter_order, step, filter, n, good, toxic, fails = filter AS alone, contains(fails, filter) AS failing,
               length(translate(earlier, fails, '')) = length(earlier) AS reached
        FROM counts, steps),
    measured AS (
        SELECT part, filter_order, step, filter,
               coalesce(sum(n) FILTER (reached AND NOT failing), 0) AS kept, coalesce(sum(n) FILTER (reached AND failing), 0) AS removed,
               coalesce(sum(n) FILTER (NOT reached AND failing), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
               coalesce(sum(good) FILTER (reached AND failing), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (reached AND failing), 0) AS toxic_lost
        FROM met GROUP BY part, filter_order, step, filter)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
    FROM measured"""

PLAIN_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
    WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, {PLAIN_WORDS} AS words FROM documents),
    items AS (SELECT item_id, words, least(10, len(words)) AS size
              FROM (SELECT item_id, {PLAIN_WORDS} AS words FROM benchmark) WHERE len(words) > 0),
    phrases AS (
        SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)),
    windows AS (
        SELECT doc, size, i, array_to_string(words[i:i + size - 1], ' ') AS phrase
        FROM (SELECT doc, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM items))),
    met AS (SELECT doc, item_id, i, size FROM windows JOIN phrases USING (size, phrase)),
    covered AS (SELECT doc, count(DISTINCT i + j) AS n_hit FROM met, range(10) t(j) WHERE j < size GROUP BY doc),
    listed AS (
        SELECT doc, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
        FROM (SELECT DISTINCT doc, CAST(item_id AS VARCHAR) AS name FROM met WHERE item_id IS NOT NULL) GROUP BY doc)
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (doc) LEFT JOIN listed USING (doc)"""

HARD_NEGATIVES = """
    WITH usable AS (
        SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER hardest AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
           score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW hardest AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER hardest <= 5"""
