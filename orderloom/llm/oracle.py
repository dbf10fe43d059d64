"""DuckDB SQL for the operators that SQL can express."""

_WORD = r"'[^\x20\x09-\x0D]+'"

SUBSTRING_DEDUP = rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents
), windows AS (
    SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS seq
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20)
), ranked AS (
    SELECT doc_id, s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) AS nth FROM windows
), gone AS (
    SELECT DISTINCT doc_id, s + i AS k
    FROM (SELECT doc_id, s, unnest(range(0, 20)) AS i FROM ranked WHERE nth > 1)
), singles AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM words
), kept AS (
    SELECT s.doc_id, string_agg(s.word, ' ' ORDER BY s.k) AS joined, count(*) AS n
    FROM singles s ANTI JOIN gone g USING (doc_id, k) GROUP BY s.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(k.joined, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

CHAT_FORMAT = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM turns
), whole AS (
    SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY place) AS said
    FROM placed GROUP BY conv_id
), distinct_said AS (
    SELECT said, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM whole GROUP BY said, n_turns
), prefixes AS (
    SELECT DISTINCT list_slice(said, 1, n) AS said
    FROM (SELECT said, unnest(range(1, n_turns)) AS n FROM distinct_said)
)
SELECT d.conv_id, d.n_turns, d.n_copies,
    array_to_string(list_transform(d.said, lambda x:
        '<|im_start|>' || coalesce(x.r, 'unknown') || chr(10) || coalesce(x.t, '') || '<|im_end|>' || chr(10)
    ), '') AS chat
FROM distinct_said d ANTI JOIN prefixes p ON d.said = p.said
"""

EXACT_DEDUP = """
SELECT doc_id,
    max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
    count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

QUALITY_RULES = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, {_WORD}) AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT doc_id, i, list_slice(w, i, i + 2) AS seq
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), twice AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS n FROM windows
), repeats AS (
    SELECT doc_id, count(DISTINCT i + j) AS n
    FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS j FROM twice WHERE n > 1) GROUP BY doc_id
), measured AS (
    SELECT w.doc_id, w.text, CAST(len(w.w) AS BIGINT) AS n_words,
        CAST(list_sum(list_transform(w.w, lambda x: length(x))) AS BIGINT) AS chars,
        CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(w.lines) AS BIGINT) AS n_lines,
        CAST(len(w.lines) - len(list_distinct(w.lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
    FROM words w LEFT JOIN repeats r USING (doc_id)
), based AS (
    SELECT *, coalesce(chars, 0) AS word_chars,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
        OR 100 * n_repeat_words > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
        OR 100 * len(regexp_extract_all(text, '\p{{Lu}}')) > 30 * word_chars
        OR 100 * len(regexp_extract_all(text, '!')) > 10 * n_words) AS kept
FROM based
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}
    ) AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, md5_number(array_to_string(list_slice(w, s, s + 4), ' ')) AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
    WHERE 100 * k >= 80 * (s.n + t.n - k)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.x = d.doc_id
GROUP BY d.doc_id, s.n
"""

_CRC_TABLE = """
crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(range(8), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
        FROM range(256) AS r(i)
    )
)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's bytes; needs ``t`` from ``crc_table``."""
    digits = f"hex(encode({text}))"

    def digit(at: str) -> str:
        return f"(strpos('0123456789ABCDEF', substr({digits}, {at}, 1)) - 1)"

    number = f"16 * {digit('2 * i + 1')} + {digit('2 * i + 2')}"
    return (
        f"xor(list_reduce(list_transform(range(strlen({text})), lambda i: CAST({number} AS BIGINT)), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
    )


def _merkle_leaf(n_chars: str) -> str:
    parts = [
        f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
        for x in ("doc_id", "source", "lang", n_chars, "text")
    ]
    return f"sha256({' || '.join(parts)})"


MERKLE_MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE}, leaves AS (
    SELECT doc_id, lang, {_merkle_leaf("n_chars")} AS leaf,
        CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0
            THEN {_merkle_leaf("n_chars + 1")} ELSE {_merkle_leaf("n_chars")} END AS tampered
    FROM documents, crc_table
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY lang) AS total
    FROM leaves
), tree AS (
    SELECT lang, 0 AS level, place, leaf AS node, total FROM placed
    UNION ALL
    SELECT lang, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (total + 1) // 2
    FROM tree WHERE total > 1 GROUP BY lang, level, place // 2, total
), subroots AS (
    SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS total
    FROM tree WHERE total = 1
), crown AS (
    SELECT 0 AS level, place, node, total FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (total + 1) // 2
    FROM crown WHERE total > 1 GROUP BY level, place // 2, total
), folds AS (
    SELECT doc_id, lang, leaf, tampered AS node, '' AS proof, 0 AS level, place, total FROM placed
    UNION ALL
    SELECT f.doc_id, f.lang, f.leaf,
        sha256(CASE WHEN f.place % 2 = 1 THEN s.node || f.node ELSE f.node || coalesce(s.node, '') END),
        f.proof || coalesce(s.node, ''), f.level + 1, f.place // 2, (f.total + 1) // 2
    FROM folds f LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM f.lang
        AND s.level = f.level AND s.place = xor(f.place, 1)
    WHERE f.total > 1
), ends AS (
    SELECT f.doc_id, f.leaf, s.node AS subroot, f.node, f.proof, 0 AS level, s.place, s.total
    FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.total = 1
    UNION ALL
    SELECT e.doc_id, e.leaf, e.subroot,
        sha256(CASE WHEN e.place % 2 = 1 THEN s.node || e.node ELSE e.node || coalesce(s.node, '') END),
        e.proof || coalesce(s.node, ''), e.level + 1, e.place // 2, (e.total + 1) // 2
    FROM ends e LEFT JOIN crown s ON s.level = e.level AND s.place = xor(e.place, 1)
    WHERE e.total > 1
)
SELECT e.doc_id, e.leaf, e.subroot, c.node AS root, sha256(e.proof) AS proof_sha256,
    e.node AS folded_root, e.node = c.node AS verified
FROM ends e JOIN crown c ON c.total = 1 WHERE e.total = 1
"""

_LOWER_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

IMPORTANCE_RESAMPLE = f"""
WITH {_CRC_TABLE}, corpus AS (
    SELECT row_number() OVER () AS r, doc_id, {_LOWER_WORDS} AS w FROM documents
), wanted AS (
    SELECT unnest({_LOWER_WORDS}) AS word FROM benchmark
), features AS (
    SELECT r, unnest(w) AS word FROM corpus
), buckets AS (
    SELECT word, {_crc32("word")} % 10000 AS b
    FROM (SELECT word FROM features UNION SELECT word FROM wanted), crc_table
), corpus_counts AS (
    SELECT b, count(*) AS n FROM features JOIN buckets USING (word) GROUP BY b
), target_counts AS (
    SELECT b, count(*) AS n FROM wanted JOIN buckets USING (word) GROUP BY b
), sums AS (
    SELECT (SELECT count(*) FROM features) AS s, (SELECT count(*) FROM wanted) AS t
), gains AS (
    SELECT b, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (sums.s + 10000)
        / (CAST(coalesce(c.n, 0) + 1 AS DOUBLE) * (sums.t + 10000)))) AS BIGINT) AS gain
    FROM corpus_counts c FULL JOIN target_counts t USING (b), sums
), weights AS (
    SELECT r, CAST(sum(gain) AS BIGINT) AS weight
    FROM features JOIN buckets USING (word) JOIN gains USING (b) GROUP BY r
), draws AS (
    SELECT r, list_reduce(list_transform(range(1, 9), lambda i: CAST(strpos('0123456789abcdef',
            substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), i, 1)) - 1 AS BIGINT)),
        lambda a, x: 16 * a + x) AS h
    FROM corpus
), scored AS (
    SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM corpus LEFT JOIN weights USING (r) JOIN draws USING (r)
), ranked AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.score,
    CASE WHEN k.place <= 10 * k.n // 100 THEN k.place END AS rank
FROM scored s LEFT JOIN ranked k USING (r)
"""
