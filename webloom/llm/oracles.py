"""DuckDB SQL for the queries that SQL can express; the others have brute-force tests."""

ORACLES = {
    "op4_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h,
                   length(coalesce(text, '')) AS n
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
        FROM t WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
    """,
    "op7_line_dedup": r"""
        WITH numbered AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        line AS (
            SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos
            FROM numbered),
        keyed AS (
            SELECT *, translate(
                regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM line),
        holder AS (
            SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        judged AS (
            SELECT k.*, coalesce(h.first <> k.doc_id, false) AS gone
            FROM keyed k LEFT JOIN holder h USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op11_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                             (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
        sized AS (
            SELECT *, length('### : </turn>') + 1 + length(role) + length(text)
                + len(regexp_extract_all(role, '[\\#<:]'))
                + len(regexp_extract_all(text, '\\|</turn>|<\|'))
                + coalesce(list_sum(list_transform(
                    regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS chars
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op12_spelling": r"""
        WITH RECURSIVE bits AS (
            SELECT i AS slot, 0 AS step, i::BIGINT AS crc FROM range(256) AS r(i)
            UNION ALL
            SELECT slot, step + 1,
                   CASE WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END
            FROM bits WHERE step < 8),
        slots AS (SELECT list(crc ORDER BY slot) AS t FROM bits WHERE step = 8),
        docs AS (
            SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head,
                   regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[A-Za-z\x{00C0}-\x{00FF}]+') AS runs
            FROM documents WHERE text IS NOT NULL),
        run AS (SELECT head, unnest(runs) AS run FROM docs),
        distinct_run AS (SELECT head, run, count(*) AS n FROM run GROUP BY ALL),
        summed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(
                    range(1, (length(hex(encode(head || run))) // 2 + 1)::BIGINT),
                    lambda i: ('0x' || substr(hex(encode(head || run)), 2 * i - 1, 2))::BIGINT)),
                lambda crc, byte: xor(crc // 256, t[(xor(crc, byte) & 255) + 1]))) AS h
            FROM distinct_run, slots),
        word AS (
            SELECT CASE WHEN h % 97 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, (h % length(run) + 2)::BIGINT)
                ELSE run END AS word, sum(n)::BIGINT AS n
            FROM summed GROUP BY ALL),
        words AS (SELECT word, n FROM word WHERE length(word) >= 5 AND n >= 3),
        cut AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n
            FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION
            SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION
            SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other,
                   max(other_n) AS other_n
            FROM near GROUP BY word),
        formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN other_n >= 2 * n THEN other END AS form,
                   CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
            FROM words LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, word AS root, form AS next FROM formed
            UNION ALL
            SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next = f.word)
        SELECT word, form, root, n, n_near, form_n
        FROM formed JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
    """,
    "op13_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
                   list_inner_product(a.x, b.x)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positive AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN scored USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5
    """,
}
