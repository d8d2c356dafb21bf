"""SQL counterparts of the document queries that SQL can express."""

from __future__ import annotations

from linewarden.llm.ledger import MEASURES, RULES
from linewarden.llm.phrases import COVERED, MIN_COUNT, SCALE, TOP
from linewarden.llm.spread import MIN_SITES, MOST_REMOVED

#: The blanks that are cut from the ends of a line.
BLANKS = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

WORDS = r"[^\x20\x09-\x0D]+"

LLM_ORACLE: dict[str, str] = {
    "op2_ledger": rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS row, doc_id, text, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS lines
            FROM documents
        ), places AS (
            SELECT row, words, unnest(range(1, len(words) - 1)) AS spot FROM texts WHERE len(words) >= 3
        ), windows AS (
            SELECT row, spot, count(*) OVER (PARTITION BY row, words[spot], words[spot + 1], words[spot + 2]) AS times FROM places
        ), covered AS (
            SELECT row, count(DISTINCT spot + k) AS n FROM windows, range(3) AS shift(k) WHERE times > 1 GROUP BY row
        ), measured AS (
            SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
                length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
                len(lines) AS n_lines,
                len(list_filter(words, lambda w: regexp_matches(w, '[A-Z][^a-z]*[A-Z]') AND NOT regexp_matches(w, '[a-z]'))) AS n_capital_words,
                len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words
            FROM texts LEFT JOIN covered USING (row)
        ), judged AS (
            SELECT *, {" + ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, c in enumerate(RULES.values()))} AS failures
            FROM measured
        )
        SELECT doc_id, {", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in MEASURES)}, CAST(failures AS BIGINT) AS failures,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failures = 0 AS kept
        FROM judged
    """,
    "op9_line_spread": f"""
        WITH lines AS (
            SELECT doc_id, coalesce(source, '') AS site, trim(piece, {BLANKS}) AS line
            FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS piece FROM documents)
            WHERE doc_id IS NOT NULL
        ), full_lines AS (
            SELECT * FROM lines WHERE line <> ''
        ), spread AS (
            SELECT line, min(doc_id) AS keeper FROM full_lines GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}
        ), hits AS (
            SELECT doc_id, list(DISTINCT line) AS cut, sum(length(line)) AS cut_chars
            FROM full_lines JOIN spread USING (line) WHERE doc_id > keeper GROUP BY doc_id
        ), whole AS (
            SELECT doc_id, sum(length(line)) AS all_chars FROM full_lines GROUP BY doc_id
        ), decided AS (
            SELECT doc_id, cut FROM hits JOIN whole USING (doc_id) WHERE cut_chars <= {MOST_REMOVED} * all_chars
        ), cleaned AS (
            SELECT documents.doc_id, text, string_split(text, chr(10)) AS pieces, cut
            FROM documents LEFT JOIN decided USING (doc_id)
        ), kept AS (
            SELECT *, list_filter(pieces, lambda x: NOT list_contains(cut, trim(x, {BLANKS}))) AS stays FROM cleaned
        )
        SELECT doc_id,
            CASE WHEN cut IS NULL THEN text ELSE array_to_string(stays, chr(10)) END AS text,
            CAST(CASE WHEN cut IS NULL THEN 0 ELSE len(pieces) - len(stays) END AS BIGINT) AS lines_removed
        FROM kept
    """,
    "op12_boundaries": rf"""
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
                regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*{WORDS}|[\x20\x09-\x0D]+') AS units
            FROM documents
        ), numbered AS (
            SELECT *, len(units) AS n, {", ".join(f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))}
            FROM drawn
        ), decided AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM numbered
        ), parted AS (
            SELECT *, array_to_string(units[:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
                array_to_string(units[high + 1:], '') AS suffix
            FROM decided
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
            CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
            CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
            sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM parted
    """,
    "op13_rollup": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents WHERE text IS NOT NULL
        ), words AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
        ), sizes AS (
            SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang
        ), grams AS (
            SELECT lang, size, array_to_string(ws[spot:spot + size - 1], ' ') AS phrase
            FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS spot FROM words, range(1, 5) AS lengths(size))
        ), counts AS (
            SELECT lang, size, phrase, CAST(count(*) AS BIGINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
        ), cuts AS (
            SELECT *, array_to_string(string_split(phrase, ' ')[:k], ' ') AS f, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS e
            FROM (SELECT *, unnest(range(1, size)) AS k FROM counts WHERE size > 1)
        ), judged AS (
            SELECT c.lang, c.phrase, c.size, c.a, x.a AS l, y.a AS r, k,
                CAST(CAST({SCALE} AS HUGEINT) * c.a // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
            FROM cuts AS c JOIN counts AS x ON x.lang = c.lang AND x.phrase = f JOIN counts AS y ON y.lang = c.lang AND y.phrase = e
        ), least AS (
            SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_parts AS (
            SELECT DISTINCT lang, a, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, size - s + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS s FROM counts WHERE size > 2))
        ), covered AS (
            SELECT lang, phrase, max(a) AS longest FROM inner_parts GROUP BY ALL
        )
        SELECT least.lang, CAST(row_number() OVER (PARTITION BY least.lang ORDER BY score DESC, a DESC, encode(phrase)) AS BIGINT) AS rank,
            phrase, a, l, r, n, score
        FROM least JOIN sizes USING (lang) LEFT JOIN covered USING (lang, phrase)
        WHERE longest IS NULL OR 100 * CAST(longest AS HUGEINT) < {COVERED} * CAST(a AS HUGEINT) QUALIFY rank <= {TOP}
    """,
}
