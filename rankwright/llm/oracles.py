"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from rankwright.llm.quality import LineRules

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The table of the reflected CRC-32 by its polynomial, and a checksum over a text's bytes.
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST(('0x' || h) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _op4() -> str:
    return """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5"""


def _op6(rules: LineRules = LineRules()) -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def count(pattern: str) -> str:
        return f"(length(line) - length(regexp_replace(line, {quoted(pattern)}, '', 'g')))"

    fault = f"""(n > 0 AND (
        {count(rules.symbols)} > {rules.max_symbols!r}e0 * n
        OR regexp_matches(line, {quoted("(?i)" + rules.navigation)}) OR regexp_matches(line, {quoted("(?i)" + rules.boilerplate)})
        OR (n < {rules.prose_from} AND NOT regexp_matches(rtrim(line, ' '), {quoted(rules.sentence_end)}))
        OR (n >= {rules.ends_from} AND len(regexp_extract_all(line, '[.!?]+')) > {rules.max_ends!r}e0 * n)
        OR (n >= {rules.distinct_from} AND len(list_distinct(w)) < {rules.min_distinct!r}e0 * n)))"""
    return f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
        windows AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
                    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
        twice AS (SELECT doc_id, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1),
        covered AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM windows JOIN twice USING (doc_id, a, b, c), range(3) AS r(d) GROUP BY doc_id),
        lines AS (SELECT doc_id, line, regexp_extract_all(line, '{_WORD}') AS w, len(regexp_extract_all(line, '{_WORD}')) AS n
                  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)),
        judged AS (SELECT doc_id, CAST(sum(n) FILTER (NOT {fault}) AS BIGINT) AS kept_words,
                          count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines FROM lines GROUP BY doc_id),
        counted AS (
            SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, n_dup_lines,
                   coalesce(covered.n, 0) AS n_repeat_words, coalesce(kept_words, 0) AS kept_words
            FROM docs LEFT JOIN covered USING (doc_id) JOIN judged USING (doc_id))
        SELECT *, base_failed = false AND n_words - kept_words <= {rules.max_lost!r}e0 * n_words AS kept FROM (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)"""


def _op8() -> str:
    return f"""
        WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, w[i : least(i + 2, len(w))] AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM named LEFT JOIN sizes USING (doc_id)"""


def _op9() -> str:
    cost = "-ln((CAST(('0x' || substr(md5('k' || doc_id || '#' || s), 1, 13)) AS BIGINT) + 5e-1) / 4503599627370496e0)"
    return f"""
        WITH {_CRC_TABLE},
        costs AS (SELECT doc_id, s, {cost} AS cost FROM documents, range(41) AS r(s)),
        placed AS (SELECT doc_id, CAST(arg_min(s, cost) FILTER (s < 40) AS INTEGER) AS shard, CAST(arg_min(s, cost) AS INTEGER) AS grown_shard
                   FROM costs GROUP BY doc_id)
        SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, {_crc32("coalesce(text, '')")} AS text_crc32, 'key' AS law,
               shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
        FROM documents JOIN placed USING (doc_id), crc_table"""


def _op10() -> str:
    escaped = r"replace(replace(replace(text, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>')"
    return rf"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(4 + length(role) + 2 + length({escaped}) + 8) AS BIGINT) AS formatted_chars,
               regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                   ORDER BY turn, role, text), 's?(ua)+') AS valid
        FROM turns GROUP BY conv_id"""


def _op11() -> str:
    return f"""
        WITH {_CRC_TABLE},
        turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
                  FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
        rebuilt AS (
            SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
            UNION ALL SELECT conv_id, 1, pos, role, text FROM convs JOIN turns USING (conv_id) WHERE pos > h),
        placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, text,
                          sha256(length(role) || ':' || role || text) AS turn FROM rebuilt),
        pathed AS (SELECT conv_id, depth, text, string_agg(turn, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
                   UNION ALL SELECT conv_id, 0, '', '' FROM convs),
        prefixes AS (SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS above,
                            depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM pathed),
        nodes AS (SELECT path, depth, min(conv_id) AS conv_id, any_value(above) AS above, count(*) AS n_convs,
                         (count(*) - 1) * any_value(len(regexp_extract_all(text, '{_WORD}'))) AS own_saved,
                         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
                  FROM prefixes GROUP BY path, depth),
        children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
        facts AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
        sums AS (SELECT p.path, count(*) FILTER (f.n_children = 0) AS n_leaves, CAST(sum(f.own_saved) AS BIGINT) AS saved_tokens
                 FROM prefixes p JOIN facts f ON f.conv_id = p.conv_id AND f.depth >= p.depth GROUP BY p.path)
        SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
        FROM facts f JOIN sums USING (path) LEFT JOIN nodes p ON p.path = f.above"""


def _op13() -> str:
    def draw(i: int) -> str:
        return f"CAST(('0x' || substr(digest, {8 * i + 1}, 8)) AS BIGINT)"

    def joined(first: str, last: str) -> str:
        return f"array_to_string(lines[{first} : {last}], '')"

    return f"""
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS digest,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines FROM documents),
        cuts AS (SELECT *, len(lines) AS n, {draw(0)} % (len(lines) + 1) AS x, {draw(1)} % (len(lines) + 1) AS y FROM docs),
        parts AS (
            SELECT *, {joined("1", "least(x, y)")} AS p, {joined("least(x, y) + 1", "greatest(x, y)")} AS m, {joined("greatest(x, y) + 1", "n")} AS s,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {draw(2)} % 100 >= 100
                        THEN 'plain' WHEN {draw(3)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM parts"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_no_random_access": _op4(),
        "op6_line_rules": _op6(),
        "op8_fast_similarity_sketch": _op8(),
        "op9_rendezvous_sharding": _op9(),
        "op10_chat_format": _op10(),
        "op11_prefix_trie": _op11(),
        "op13_swar_fill_in_middle": _op13(),
    }
