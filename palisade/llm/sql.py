"""The same results in DuckDB SQL, where SQL can express them over whole tables."""

from __future__ import annotations

from palisade.llm import licenses
from palisade.llm.sharding import PRIME, ROUNDS

SQL: dict[str, str] = {}

SQL["op5_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(words[i : i + 34], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)
), hits AS (
    SELECT doc_id, i FROM win WHERE w IN (SELECT w FROM win GROUP BY w HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM hits
), word AS (
    SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS w FROM d
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS text
    FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

SQL["op9_near_dedup"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
    SELECT DISTINCT doc_id, w FROM (
        SELECT doc_id, array_to_string(words[i : i + 3], ' ') AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 2)) AS i FROM d WHERE len(words) >= 4)
        UNION ALL
        SELECT doc_id, array_to_string(words, ' ') FROM d WHERE len(words) BETWEEN 1 AND 3
    )
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
same AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.w = y.w AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM same JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * m >= 80 * (p.n + q.n - m)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
), root AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM root LEFT JOIN n USING (doc_id)
"""

SQL["op7_suffix_array_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(words[i + 1 : i + 50], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(len(words) - 49)) AS i FROM d WHERE len(words) >= 50)
), hits AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
    FROM win WHERE w IN (SELECT w FROM win GROUP BY w HAVING count(*) > 1)
), islands AS (
    SELECT doc_id, i, sum(CASE WHEN before >= i - 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM hits
)
SELECT doc_id, CAST(any_value(len(words)) AS BIGINT) AS n_words, CAST(min(i) AS BIGINT) AS start, CAST(max(i) + 50 AS BIGINT) AS "end"
FROM islands JOIN d USING (doc_id) GROUP BY doc_id, island
"""


def _network(x: str, seed: int = 1) -> str:
    """The Feistel network of ``sharding.permuted`` on the expression ``x``; expects the moduli l_m and r_m as columns."""
    steps = f"SELECT ({x}) // r_m AS l, ({x}) % r_m AS r"
    state = seed % PRIME
    for i in range(ROUNDS):
        state = (state * 48271 + 11 * i + 7) % PRIME
        modulus = "l_m" if i % 2 == 0 else "r_m"
        steps = (
            f"SELECT r AS l, (l + ((v * v) % {PRIME} * 39373 + v) % {PRIME}) % {modulus} AS r "
            f"FROM (SELECT l, r, (r % {PRIME} * 16807 + {state}) % {PRIME} AS v FROM ({steps}))"
        )
    return f"(SELECT l * r_m + r FROM ({steps}))"


# CRC-32 isn't built into DuckDB: the usual table of 256 entries by its rule, then byte by byte.
SQL["op3_feistel_sharding"] = f"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS steps
    FROM (SELECT unnest(range(256)) AS i)
), doc AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS octets
    FROM documents
), rows AS (
    SELECT doc_id, size,
           xor(list_reduce(list_prepend(4294967295, octets), lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS text_crc32
    FROM doc, crc
), numbered AS (
    SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', coalesce(doc_id::VARCHAR, '-'), size::VARCHAR, text_crc32::VARCHAR)),
                                 doc_id NULLS FIRST, size, text_crc32) - 1 AS global_row
    FROM rows
), moduli AS (
    SELECT n, l_m, (n + l_m - 1) // l_m AS r_m
    FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS l_m FROM rows)
), walk AS (
    SELECT global_row, n, l_m, r_m, {_network("global_row")} AS p FROM numbered, moduli
    UNION ALL
    SELECT global_row, n, l_m, r_m, {_network("p")} FROM walk WHERE p >= n
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(p % 16 AS INTEGER) AS shard, CAST(p // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, CAST(global_row AS BIGINT) AS global_row
FROM numbered JOIN walk USING (global_row) WHERE p < n
"""

SQL["op10_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(least(greatest(1024 * CAST(x AS DOUBLE), -72057594037927936), 72057594037927936)) AS HUGEINT))
           AS vector FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2])), 0) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.vector) = len(c.vector)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, TRY_CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""

SQL["op2_decontamination"] = r"""
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
    UNION ALL
    SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') FROM benchmark
), s AS (
    SELECT DISTINCT kind, id, shingle FROM (
        SELECT kind, id, array_to_string(w[i : i + 4], ' ') AS shingle
        FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
        UNION ALL
        SELECT kind, id, '<' || array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4
    )
), n AS (SELECT id AS item_id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY id),
pairs AS (
    SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
    FROM s d JOIN s i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle GROUP BY ALL
)
SELECT doc_id, item_id, n AS n_item_shingles, shared AS n_shared, CAST(shared AS DOUBLE) / n AS containment
FROM pairs JOIN n USING (item_id) WHERE CAST(shared AS DOUBLE) / n >= CAST(0.8 AS DOUBLE)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _normalised(sentence: str) -> str:
    sentence = f"lower({sentence})"
    for pattern, replacement in licenses.STEPS:
        sentence = f"regexp_replace({sentence}, {_text(pattern)}, {_text(replacement)}, 'g')"
    return sentence


def _listed(rows: list[tuple[str, str]], names: str) -> str:
    return "(VALUES " + ", ".join(f"({i}, {_text(a)}, {_text(b)})" for i, (a, b) in enumerate(rows)) + f") AS t({names})"


SQL["op1_license_scan"] = rf"""
WITH RECURSIVE known AS (
    SELECT DISTINCT id, {_normalised("text")} AS s FROM {_listed(licenses.known_sentences(), "n, id, text")}
), doc AS (
    SELECT doc_id, regexp_replace(text, {_text(licenses.LINE_START)}, chr(10), 'g') AS bare FROM documents
    WHERE {" OR ".join(f"contains(lower(text), {_text(hint)})" for hint in licenses.HINTS)}
), body AS (
    SELECT doc_id, 'lines' AS reading, regexp_split_to_array(bare, {_text(licenses.SENTENCE_END)}) AS parts FROM doc
    UNION ALL
    SELECT doc_id, 'paragraphs',
           regexp_split_to_array(regexp_replace(bare, '([^\r\n])\r?\n([^\r\n])', '\1 \2', 'g'), {_text(licenses.PARAGRAPH_END)}) FROM doc
), sentence AS (
    SELECT doc_id, reading, place, {_normalised("part")} AS s
    FROM (SELECT doc_id, reading, unnest(range(len(parts))) AS place, unnest(parts) AS part FROM body)
), reading AS (
    SELECT doc_id, reading, count(id) AS n, coalesce(list(id ORDER BY place) FILTER (id IS NOT NULL), []) AS ids,
           count(*) FILTER (id IS NULL AND regexp_matches(s, {_text(licenses.OPEN)})) AS open
    FROM sentence LEFT JOIN known USING (s) WHERE s <> '' GROUP BY ALL
), best AS (
    SELECT * FROM reading QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, reading) = 1
), rule AS (SELECT n, name, ' ' || replace(part, ' ', '  ') || ' ' AS part FROM {_listed(licenses.RULES, "n, name, part")}),
applied AS (
    SELECT doc_id, 0 AS step, array_to_string(list_transform(list_filter(ids, lambda i: i <> {_text(licenses.NEUTRAL)}), lambda i: ' ' || i || ' '), '') AS rest,
           []::VARCHAR[] AS names
    FROM best WHERE len(ids) > 0
    UNION ALL
    SELECT doc_id, step + 1, replace(rest, part, ' | '), CASE WHEN contains(rest, part) THEN list_append(names, name) ELSE names END
    FROM applied JOIN rule ON rule.n = applied.step
), final AS (SELECT * FROM applied WHERE step = (SELECT count(*) FROM rule)),
firsts AS (
    SELECT doc_id, string_agg(name, '|' ORDER BY place) AS licenses
    FROM (SELECT doc_id, name, min(place) AS place FROM (SELECT doc_id, unnest(names) AS name, unnest(range(len(names))) AS place FROM final) GROUP BY ALL)
    GROUP BY doc_id
)
SELECT doc_id, coalesce(array_to_string(ids, ' '), '') AS sentence_ids, coalesce(licenses, '') AS licenses,
       CASE WHEN regexp_replace(coalesce(rest, ''), '[| ]+', '', 'g') <> '' THEN 'partial' WHEN licenses IS NOT NULL THEN 'known'
            WHEN open > 0 THEN 'unknown' ELSE 'none' END AS verdict
FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN final USING (doc_id) LEFT JOIN firsts USING (doc_id)
"""


# The CRC by a table of 256 entries made by its rule, as above.
SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS steps
    FROM (SELECT unnest(range(256)) AS i)
), run AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents
    ) WHERE len(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
        lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
    FROM run, crc
), word AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 199 = 0 THEN run[: h % len(run)] || run[h % len(run) + 2 :] ELSE run END AS word, n FROM hashed)
    WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), open AS (
    SELECT word, n, len(word) AS size, i, word[: i - 1] || '*' || word[i + 1 :] AS swapped, word[: i - 1] || word[i + 1 :] AS shorter
    FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM word)
), near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM open a JOIN open b ON a.swapped = b.swapped AND a.word <> b.word
    UNION
    SELECT a.word, a.n, b.word, b.n FROM open a JOIN word b ON a.shorter = b.word
    UNION
    SELECT b.word, b.n, a.word, a.n FROM open a JOIN word b ON a.shorter = b.word
), formed AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), full_row AS (
    SELECT word.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
    FROM word LEFT JOIN formed ON word.word = formed.word
), chain AS (
    SELECT word, word AS root, form AS next FROM full_row
    UNION ALL
    SELECT chain.word, chain.next, step.form FROM chain JOIN full_row step ON step.word = chain.next
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM full_row JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
"""
