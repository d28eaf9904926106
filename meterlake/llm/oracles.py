"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _windows(size: int, lists: str) -> str:
    """(row keys, pos, spelled) of all windows of a table with ``ws``, a list of words; spelled with a byte no word holds."""
    return f"""
        SELECT doc_id, unnest(range(1, len(ws) - {size} + 2)) AS pos, ws FROM {lists} WHERE len(ws) >= {size}"""


SUBSTRINGS = f"""
WITH lists AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
placed AS ({_windows(50, "lists")}),
spelled AS (SELECT doc_id, pos, array_to_string(ws[pos:pos + 49], ' ') AS w FROM placed),
owned AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY w) AS owner FROM spelled),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM owned WHERE owner < doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM lists),
kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS kept, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM lists LEFT JOIN kept USING (doc_id)
"""

LINES = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
named AS (
    SELECT *, {ASCII_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
repeated AS (SELECT k FROM named WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT n.*, r.k IS NOT NULL AS gone FROM named n LEFT JOIN repeated r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _hit_words(size: int) -> str:
    """The words of each document inside windows that the document holds twice or more."""
    return f"""
        SELECT DISTINCT doc_id, unnest(range(pos, pos + {size})) AS pos FROM (
            SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[pos:pos + {size - 1}], ' ')) AS n
            FROM ({_windows(size, "lists")})) WHERE n > 1"""


QUALITY = f"""
WITH lists AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
hit AS ({_hit_words(8)}),
longer AS (SELECT DISTINCT doc_id FROM ({_hit_words(101)})),
repeated AS (SELECT doc_id, count(*) AS n, sum(length(ws[pos])) AS chars FROM hit JOIN lists USING (doc_id) GROUP BY doc_id),
held AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM lists)
    WHERE regexp_matches(line, {WORD}) GROUP BY doc_id),
base AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
        (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(held.n, 0)::BIGINT AS n_dup_lines,
        coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(repeated.chars, 0)::BIGINT AS repeated_chars,
        longer.doc_id IS NOT NULL AS too_long
    FROM lists LEFT JOIN held USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN longer USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, repeated_chars,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND repeated_chars <= 0.3::DOUBLE * word_chars AND NOT too_long AS kept
FROM base
"""

ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = f"""
WITH lists AS (
    SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, {ITEM_WORD}) AS ws FROM documents),
items AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, {ITEM_WORD}) AS ws
    FROM benchmark),
sized AS (SELECT *, least(13, len(ws)) AS size FROM items WHERE len(ws) > 0),
windows AS (
    SELECT DISTINCT item, size, array_to_string(ws[pos:pos + size - 1], ' ') AS w
    FROM (SELECT item, size, ws, unnest(range(1, len(ws) - size + 2)) AS pos FROM sized)),
sizes AS (SELECT DISTINCT size FROM windows),
placed AS (
    SELECT doc_id, size, pos, array_to_string(ws[pos:pos + size - 1], ' ') AS w
    FROM (SELECT doc_id, size, ws, unnest(range(1, len(ws) - size + 2)) AS pos FROM lists, sizes WHERE len(ws) >= size)),
found AS (SELECT doc_id, pos, size, item FROM placed JOIN windows USING (size, w)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS pos FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(ws) AS contaminated
FROM lists LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: Of each turn its formatted length: the marks and the text with its escapes.
CHAT = r"""
WITH spoken AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
    SELECT *, length('<|im_start|><|im_sep|><|im_end|>') + 1 + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
        + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS size,
        row_number() OVER (PARTITION BY conv_id, own ORDER BY turn NULLS FIRST, role, text) AS pos, count(*) OVER (PARTITION BY conv_id, own) AS n
    FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM spoken)),
summed AS (SELECT *, sum(size) OVER (PARTITION BY conv_id, own ORDER BY pos) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (role = 'assistant' OR pos = n)::BIGINT AS formatted_chars,
    count(*) FILTER (role = 'assistant' OR pos = n) AS n_examples
FROM summed GROUP BY conv_id, own
"""

#: The draws are the first four groups of eight hexadecimal digits; list slices are from 1 and include their ends.
FILL_IN_MIDDLE = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us FROM documents),
drawn AS (
    SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (len(us) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(us) + 1) AS b,
        ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS d FROM units),
formed AS (
    SELECT *, CASE WHEN text = '' OR c >= 50 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
        WHEN d < 80 THEN 'spm' ELSE 'psm' END AS form,
        coalesce(array_to_string(us[1:least(a, b)], ''), '') AS prefix,
        coalesce(array_to_string(us[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
        coalesce(array_to_string(us[greatest(a, b) + 1:], ''), '') AS suffix FROM drawn)
SELECT doc_id, len(us)::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM formed
"""

_TERM_LIST = f"regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


def _probability(n: str, total: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * terms)"


DIVERGENCE = f"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERM_LIST} AS ts FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
placed AS (SELECT doc, lang, source, unnest(ts) AS term FROM docs),
kept AS (
    SELECT lang, term, count(*)::HUGEINT AS total FROM placed GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
counted AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM placed SEMI JOIN kept USING (lang, term) GROUP BY ALL),
languages AS (SELECT lang, count(*)::HUGEINT AS terms, sum(total)::HUGEINT AS lang_n FROM kept GROUP BY lang),
sizes AS (
    SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS group_n
    FROM groups g LEFT JOIN counted c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
priced AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, {_probability("coalesce(c.n, 0)", "group_n")} AS p, {_probability("total", "lang_n")} AS q
    FROM sizes s JOIN kept k ON s.lang = k.lang JOIN languages l ON s.lang = l.lang
    LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
higher AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM priced WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM higher))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLES = {
    "op3_substring_dedup": SUBSTRINGS,
    "op5_line_dedup": LINES,
    "op6_quality_rules": QUALITY,
    "op7_decontamination": DECONTAMINATION,
    "op10_chat_formatting": CHAT,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_source_divergence": DIVERGENCE,
}
