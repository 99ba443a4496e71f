"""SQL for DuckDB that gives the rows of the queries it can state."""

from __future__ import annotations


def chat_sql() -> str:
    """Digests of turns and of assistant texts, straight from the table.

    The length adds the control strings of a turn (12, 10 and 10 characters)
    and one backslash for each control opening in a role or text.
    """
    said = "<|im_end|><|im_start|>assistant ok"
    opens = r"(length({0}) - length(regexp_replace({0}, '<(\\*)\|', '<\1', 'g')))"
    return rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}')
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + {opens.format('role')} + length(text) + {opens.format('text')} + 32)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def warc_sql() -> str:
    """Type, reference and base32 SHA-1 of each page; five hexadecimal digits are four characters of base32."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    groups = " || ".join(
        f"substr({letters}, ((('0x' || substr(h, {5 * g + 1}, 5))::INTEGER >> {shift}) & 31) + 1, 1)" for g in range(8) for shift in (15, 10, 5, 0)
    )
    return f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
     firsts AS (SELECT h, max(page_id) AS first FROM hashed GROUP BY h)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {groups} AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM hashed JOIN firsts USING (h)
"""


def near_dedup_sql() -> str:
    """Groups of documents by the definition: all sets against all, then everything that links reach."""
    return r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM worded
), rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(y) AS component_id, sets.doc_id = min(y) AS kept
FROM sets JOIN reach ON sets.doc_id = reach.x GROUP BY sets.doc_id, s
"""


def rules_sql(words: list[str], languages: list[str], limits: tuple) -> str:
    """Base rules by positions of windows, and both Jensen-Shannon distances by their definition."""
    least_chars, least_words, most_chars, most_words = limits
    only = lambda kind: f"length(regexp_replace(t, '[^{kind}]', '', 'g'))"
    marks = "!" + '"' + r"''()+,./:;=?@\[\\\]^_`{}~-"
    hits = ", ".join(f"len(list_filter(w, lambda x: lower(x) = '{word}'))" for word in words)
    listed = ", ".join(f"'{x}'" for x in languages)
    return rf"""
WITH worded AS (
    SELECT doc_id, lang, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), starts AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM worded),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM starts),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY 1),
counted AS (
    SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {only('#*$%&|<>')} AS n_symbols,
           len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, {only('A-Z')} AS upper,
           {only('0-9')} AS digit, {only(marks)} AS punct, strlen(t) - length(t) AS wide, length(t) AS every, [{hits}] AS found
    FROM worded LEFT JOIN again USING (doc_id)
), histograms AS (
    SELECT *, [upper, digit, n_symbols, punct, wide, every - word_chars, greatest(word_chars - upper - digit - n_symbols - punct - wide, 0)] AS chars,
           list_append(found, n_words - list_sum(found)) AS common FROM counted
), cells AS (
    SELECT doc_id, lang, 'c' AS kind, unnest(range(1, len(chars) + 1)) AS k, unnest(chars) AS n FROM histograms
    UNION ALL SELECT doc_id, lang, 'w', unnest(range(1, len(common) + 1)), unnest(common) FROM histograms
), shares AS (SELECT doc_id, kind, k, n / nullif(sum(n) OVER (PARTITION BY doc_id, kind), 0) AS p FROM cells),
sums AS (SELECT lang, kind, k, sum(n) AS n FROM cells WHERE lang IN ({listed}) GROUP BY 1, 2, 3),
refs AS (SELECT lang, kind, k, n / sum(n) OVER (PARTITION BY lang, kind) AS q FROM sums),
apart AS (
    SELECT doc_id, lang, kind, coalesce(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
             + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) FILTER (p IS NOT NULL) / (2 * ln(2)), 0)), 0) AS d
    FROM shares JOIN refs USING (kind, k) GROUP BY 1, 2, 3
), paired AS (SELECT doc_id, lang, max(d) FILTER (kind = 'c') AS c, max(d) FILTER (kind = 'w') AS w FROM apart GROUP BY 1, 2),
judged AS (
    SELECT h.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           (SELECT bool_or((h.word_chars < {least_chars} OR c <= {most_chars}) AND (h.n_words < {least_words} OR w <= {most_words})) FROM paired WHERE paired.doc_id = h.doc_id) AS near,
           (SELECT min(c) FROM paired WHERE paired.doc_id = h.doc_id) AS c, (SELECT min(w) FROM paired WHERE paired.doc_id = h.doc_id) AS v
    FROM histograms h
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND near AS kept, round(c, 6) AS chars_distance, round(v, 6) AS words_distance
FROM judged
"""


def leaks_sql(units: list[str], window: int, literal: int) -> str:
    """Template windows of documents and items, joined as they are, and the slots of each occurrence.

    States whole windows only; the given items are all longer than one.
    """
    listed = ", ".join(f"'{u}'" for u in units)
    edge = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
    return rf"""
WITH texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
cut AS (SELECT side, id, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS parts FROM texts),
words AS (SELECT side, id, unnest(range(0, len(parts))) AS i, unnest(parts) AS part FROM cut),
cores AS (
    SELECT side, id, i, contains(regexp_extract(part, '^[\x20\x09-\x0D]*'), chr(10)) AS line,
           regexp_replace(part, '^[\x20\x09-\x0D]+', '') AS word, regexp_replace(regexp_replace(regexp_replace(part, '^[\x20\x09-\x0D]+', ''), '^{edge}', ''), '{edge}$', '') AS bare
    FROM words
), kinds AS (
    SELECT side, id, i, word, CASE WHEN bare = '' THEN word ELSE bare END AS core,
           regexp_matches(core, '^[0-9]') AS number, regexp_matches(core, '^([A-Z]|[\x{{C0}}-\x{{DE}}])') AS capital, regexp_matches(core, '^[A-Z][A-Z]') AS upper,
           i = 0 OR line OR regexp_matches(lag(word) OVER each, '[.!?:;")\]'']$') AS fresh, lag(core) OVER each AS before
    FROM cores WINDOW each AS (PARTITION BY side, id ORDER BY i)
), typed AS (
    SELECT side, id, i, word, CASE WHEN number THEN '#1' WHEN lower(core) IN ({listed}) AND regexp_matches(before, '^[0-9]') THEN '#2'
           WHEN capital AND NOT fresh AND NOT upper THEN '#3' END AS slot, lower(core) AS plain FROM kinds
), windows AS (
    SELECT side, id, i, list(coalesce(slot, plain)) OVER ahead AS template, list(CASE WHEN slot IS NULL THEN NULL ELSE lower(trim(word, '.,;:!?"''()[]')) END) OVER ahead AS held,
           count(*) OVER ahead AS n, count(slot) OVER ahead AS slots
    FROM typed WINDOW ahead AS (PARTITION BY side, id ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)
), used AS (SELECT * FROM windows WHERE n = {window} AND n - slots >= {literal}),
met AS (SELECT d.id AS doc_id, b.id AS item_id, d.i, d.i - b.i AS shift, d.held AS mine, b.held AS theirs FROM used d JOIN used b ON d.side = 0 AND b.side = 1 AND d.template = b.template),
pairs AS (SELECT DISTINCT doc_id, item_id, shift, x, y FROM (SELECT doc_id, item_id, shift, unnest(mine) AS x, unnest(theirs) AS y FROM met) WHERE y IS NOT NULL),
fit AS (SELECT doc_id, item_id, shift, bool_and(x = y) AS same, count(*) = count(DISTINCT y) AS one FROM pairs GROUP BY 1, 2, 3)
SELECT doc_id, item_id, count(DISTINCT i)::BIGINT AS n_windows, min(i)::BIGINT AS first_word, (max(i) + {window - 1})::BIGINT AS last_word, bool_or(coalesce(same, true)) AS same_slots
FROM met LEFT JOIN fit USING (doc_id, item_id, shift)
WHERE coalesce(one, true) GROUP BY doc_id, item_id
"""


def codebooks_sql(scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Codes by the definition: every part against every entry in every round, in whole numbers."""
    floored = "((s - ((s % n) + n) % n) // n)"
    book = lambda r: f"b{r}"
    steps = [f"""
kept AS (SELECT vec_id, label, embedding FROM embeddings
         WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS entry, len(embedding) // {parts} AS each FROM kept),
x AS (SELECT vec_id, entry, (place - 1) // each AS part, (place - 1) % each AS pos, floor({scale} * v::DOUBLE)::BIGINT AS v
      FROM (SELECT vec_id, entry, each, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS place FROM numbered)),
b0 AS (SELECT entry, part, pos, v FROM x WHERE entry < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT x.vec_id, x.part, e.entry, sum((x.v - e.v) * (x.v - e.v))::BIGINT AS d
        FROM x JOIN {book(r)} AS e ON x.part = e.part AND x.pos = e.pos GROUP BY ALL),
a{r} AS (SELECT vec_id, part, min(d * {entries} + entry)::BIGINT AS m FROM d{r} GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT m % {entries} AS entry, x.part, pos, sum(v)::BIGINT AS s, count(*)::BIGINT AS n
        FROM a{r} JOIN x ON a{r}.vec_id = x.vec_id AND a{r}.part = x.part GROUP BY ALL),
{book(r + 1)} AS (SELECT entry, part, pos, coalesce({floored}, v) AS v FROM {book(r)} LEFT JOIN s{r} USING (entry, part, pos))""")
    return f"""
WITH {','.join(steps)},
coded AS (SELECT vec_id, string_agg(lower(printf('%02x', m % {entries})), '' ORDER BY part) AS code, sum(m // {entries})::BIGINT AS error
          FROM a{rounds} GROUP BY vec_id),
sha AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM {book(rounds)})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), sha
"""


def source_audit_sql(least: int = 30, one: int = 1_000_000_000, smooth: int = 5, top: int = 50) -> str:
    """Shares of every kept term in every group, then all pairs of sources and the terms above the language."""
    letters = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    share = f"1 + ({one}::HUGEINT * (coalesce(n, 0) + {smooth})) // (size + {smooth} * terms)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {lower} AS text FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '{letters}')) AS term FROM docs),
kept AS (SELECT lang, term FROM (SELECT DISTINCT lang, r, term FROM words) GROUP BY ALL HAVING count(*) >= {least}),
groups AS (SELECT DISTINCT lang, source FROM docs),
width AS (SELECT lang, count(*) AS terms FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, terms
         FROM groups AS g JOIN kept AS k USING (lang) JOIN width USING (lang) LEFT JOIN counts AS c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, ({share})::BIGINT AS p FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS size FROM grid)),
q AS (SELECT lang, term, ({share})::BIGINT AS q FROM (
      SELECT lang, term, n, terms, sum(n) OVER (PARTITION BY lang) AS size FROM (SELECT lang, term, terms, sum(n) AS n FROM grid GROUP BY ALL))),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN apart AS d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
more AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p - q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM more))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""
