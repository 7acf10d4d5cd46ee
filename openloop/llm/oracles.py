"""DuckDB statements for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op4_exact_dedup"] = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM normal
WINDOW same AS (PARTITION BY t)
"""

# A token run of 13 with at most two substitutions holds four equal tokens in a row, so shared
# 4-grams give all alignments that can qualify; a shorter item is leaked where all of it is there.
_TOKENS = r"""list_filter(regexp_split_to_array(
    regexp_replace(lower(text), '([\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}])',
                   ' \1 ', 'g'),
    '[^\p{L}\p{N}]+'), lambda x: x <> '')"""

ORACLES["op10_decontamination"] = f"""
WITH tokens AS (
    SELECT true AS is_item, item_id AS id, {_TOKENS} AS tok FROM benchmark
    UNION ALL
    SELECT false, doc_id, {_TOKENS} FROM documents
),
words AS (
    SELECT is_item, id, len(tok) AS n, unnest(tok) AS word, generate_subscripts(tok, 1) - 1 AS pos FROM tokens
),
grams AS (
    SELECT *, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w AS gram
    FROM words WINDOW w AS (PARTITION BY is_item, id ORDER BY pos)
),
alignments AS (
    SELECT DISTINCT d.id AS doc_id, i.id AS item_id, d.pos - i.pos AS doc_start
    FROM grams AS d JOIN grams AS i ON d.gram = i.gram
    WHERE NOT d.is_item AND i.is_item AND i.n >= 13
    UNION ALL
    SELECT d.id, i.id, d.pos FROM words AS d JOIN words AS i ON d.word = i.word
    WHERE NOT d.is_item AND i.is_item AND i.n < 13 AND i.pos = 0
),
placed AS (
    SELECT a.doc_id, a.item_id, a.doc_start, i.n, i.pos, CASE WHEN d.word = i.word THEN 1 ELSE 0 END AS same
    FROM alignments AS a
    JOIN words AS i ON i.is_item AND i.id = a.item_id
    LEFT JOIN words AS d ON NOT d.is_item AND d.id = a.doc_id AND d.pos = a.doc_start + i.pos
),
runs AS (
    SELECT *, sum(same) OVER w AS near, count(*) OVER w AS width
    FROM placed
    WINDOW w AS (PARTITION BY doc_id, item_id, doc_start ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)
),
found AS (
    SELECT doc_id, item_id, doc_start, n, sum(same) AS matched
    FROM runs GROUP BY ALL HAVING coalesce(max(CASE WHEN width = 13 THEN near END) >= 11, sum(same) = n)
)
SELECT doc_id, item_id, max(matched)::INT AS n_matched, max(n)::INT AS n_tokens,
       arg_min(doc_start, (-matched, doc_start))::INT AS doc_start
FROM found GROUP BY doc_id, item_id
"""

ORACLES["op9_warc_round_trip"] = r"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
marked AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS last_id,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS digest
    FROM payloads
)
SELECT page_id, payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
FROM marked
"""

ORACLES["op5_substring_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS list FROM documents
),
words AS (
    SELECT doc_id, unnest(list) AS word, generate_subscripts(list, 1) AS place FROM texts
),
windows AS (
    SELECT *, string_agg(word, ' ') OVER ahead AS passage, count(*) OVER ahead AS width
    FROM words
    WINDOW ahead AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
),
marked AS (
    SELECT *, CASE WHEN width = 20
                   THEN row_number() OVER (PARTITION BY width, passage ORDER BY doc_id, place) > 1
                   ELSE false END AS repeats
    FROM windows
),
covered AS (
    SELECT doc_id, word, place,
           bool_or(repeats) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
               AS gone
    FROM marked
),
counted AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed,
           coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '') AS kept
    FROM covered GROUP BY doc_id
)
SELECT doc_id, len(list)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id)
"""

# A byte is two digits of the hex text; the digest of a window stands for its 200 digits.
ORACLES["op3_suffix_array_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
),
blocks AS (
    SELECT doc_id, base, substr(digits, 2 * base + 1, 1198) AS part, least(500, length(digits) // 2 - base) AS n
    FROM (SELECT doc_id, digits, unnest(range(0, length(digits) // 2, 500)) AS base FROM texts)
),
bytes AS (
    SELECT doc_id, base, part, unnest(range(n)) AS inside FROM blocks
),
windows AS (
    SELECT doc_id, base + inside AS place, substr(part, 2 * inside + 1, 2) AS pair,
           CASE WHEN 2 * inside + 200 <= length(part) THEN md5_number(substr(part, 2 * inside + 1, 200)) END AS passage
    FROM bytes
),
marked AS (
    SELECT doc_id, place, pair,
           passage IS NOT NULL AND row_number() OVER (PARTITION BY passage ORDER BY doc_id, place) > 1 AS repeats
    FROM windows
),
covered AS (
    SELECT doc_id, place, pair,
           bool_or(repeats) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
               AS gone
    FROM marked
),
edged AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) AS begins
    FROM covered
),
counted AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
           coalesce(string_agg(pair, '' ORDER BY place) FILTER (NOT gone), '') AS kept
    FROM edged GROUP BY doc_id
)
SELECT doc_id, length(digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id)
"""


# CRC-32 of the sixteen half bytes.
_CRC_OF_NIBBLES = """[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text, half a byte at a time."""
    return f"""xor(4294967295, list_reduce(
        list_transform(range(2 * strlen({text})),
                       lambda i: instr('0123456789ABCDEF', substr(hex(encode({text})), 1 + xor(i, 1), 1))::BIGINT - 1),
        lambda c, half: xor(c >> 4, {_CRC_OF_NIBBLES}[1 + (xor(c, half) & 15)]), 4294967295::BIGINT))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    fields = " || ".join(_field(f) for f in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({fields})"


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
           CASE WHEN {_crc32("(doc_id::VARCHAR)")} % 7 = 0
                THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS given
    FROM documents
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS n
    FROM hashed
),
nodes AS (
    SELECT 0 AS level, lang, place, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT level + 1, lang, place // 2, (max(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY level, lang, place // 2
),
subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
tops AS (
    SELECT 0 AS level, place, n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, (max(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, place // 2
),
lower_folds AS (
    SELECT doc_id, lang, leaf, 0 AS level, place, n, given AS digest, '' AS proof FROM leaves
    UNION ALL
    SELECT f.doc_id, f.lang, f.leaf, f.level + 1, f.place // 2, (f.n + 1) // 2,
           CASE WHEN f.place % 2 = 1 THEN sha256(s.digest || f.digest) ELSE sha256(f.digest || coalesce(s.digest, '')) END,
           f.proof || coalesce(s.digest, '')
    FROM lower_folds AS f
    LEFT JOIN nodes AS s ON s.level = f.level AND s.lang IS NOT DISTINCT FROM f.lang AND s.place = xor(f.place, 1)
    WHERE f.n > 1
),
upper_folds AS (
    SELECT f.doc_id, f.leaf, s.subroot, 0 AS level, s.place, s.n, f.digest, f.proof
    FROM lower_folds AS f JOIN subroots AS s ON s.lang IS NOT DISTINCT FROM f.lang
    WHERE f.n = 1
    UNION ALL
    SELECT f.doc_id, f.leaf, f.subroot, f.level + 1, f.place // 2, (f.n + 1) // 2,
           CASE WHEN f.place % 2 = 1 THEN sha256(s.digest || f.digest) ELSE sha256(f.digest || coalesce(s.digest, '')) END,
           f.proof || coalesce(s.digest, '')
    FROM upper_folds AS f LEFT JOIN tops AS s ON s.level = f.level AND s.place = xor(f.place, 1)
    WHERE f.n > 1
)
SELECT f.doc_id, f.leaf, f.subroot, t.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root,
       f.digest = t.digest AS verified
FROM upper_folds AS f JOIN tops AS t ON t.n = 1
WHERE f.n = 1
"""

ORACLES["op12_line_dedup"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS list FROM documents
),
lines AS (
    SELECT row_id, doc_id, unnest(list) AS line, generate_subscripts(list, 1) AS place FROM texts
),
keyed AS (
    SELECT *, regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key
    FROM lines
),
common AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row_id) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (c.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common AS c USING (key)
GROUP BY row_id
"""

# Near words share a word less one letter: less the letter at one place if they are equally long,
# else the shorter one is the longer one less a letter.
ORACLES["op13_spelling_variants"] = rf"""
WITH RECURSIVE found AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY ALL
),
hashed AS (
    SELECT run, n, {_crc32("concat(doc_id, ':', run)")} AS h FROM runs
),
edited AS (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
shortened AS (
    SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)
),
pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n
    FROM shortened AS a JOIN shortened AS b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
    UNION
    SELECT s.word, w.word, w.n FROM shortened AS s JOIN words AS w ON s.rest = w.word
    UNION
    SELECT w.word, s.word, s.n FROM shortened AS s JOIN words AS w ON s.rest = w.word
),
best AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n
    FROM pairs GROUP BY word
),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
           CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
chains AS (
    SELECT word, word AS root, form AS further FROM formed
    UNION ALL
    SELECT c.word, f.word, f.form FROM chains AS c JOIN formed AS f ON f.word = c.further
)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, root FROM chains WHERE further IS NULL) AS ends USING (word)
"""
