"""DuckDB SQL for the registered queries that SQL can express.

It says what the results are by the plainest way that small tables allow: all pairs
that share a shingle, all windows of a text, all strings of a hundred bytes.
"""

from __future__ import annotations

from hazeline.llm import curriculum, decontaminate, license_scan, quality_rules, sharding
from hazeline.llm.oracle_conversations import CONVERSATIONS
from hazeline.llm.oracle_pages import PAGES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = "coalesce(text, '')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


_NAMES = ", ".join(f"({i}, '{name}')" for i, name in enumerate(sharding.SHARDS))
_SIZE, _SHARDS = sharding.TABLE_SIZE, len(sharding.SHARDS)

SHARDING = f"""
WITH RECURSIVE names(i, name) AS (VALUES {_NAMES}),
likes AS (
    SELECT i, [({_number("'offset:' || name")} % {_SIZE} + j * ({_number("'skip:' || name")} % {_SIZE - 1} + 1))
               % {_SIZE} FOR j IN range({_SIZE})] AS slots
    FROM names
),
fill(turn, owner) AS (
    SELECT 0, [-1 FOR s IN range({_SIZE})]
    UNION ALL
    SELECT turn + 1, [CASE WHEN s = free THEN i ELSE owner[s + 1] END FOR s IN range({_SIZE})]
    FROM (
        SELECT turn, owner, i, [s FOR s IN slots IF owner[s + 1] < 0][1] AS free
        FROM fill JOIN likes ON i = turn % {_SHARDS}
        WHERE turn < {_SIZE}
    )
),
placed AS (
    SELECT doc_id, source, n_chars, ({_number("doc_id::VARCHAR")} % {_SIZE})::INTEGER AS slot FROM documents
)
SELECT doc_id, source, n_chars, slot, name AS shard
FROM placed, (SELECT owner FROM fill WHERE turn = {_SIZE}), names
WHERE names.i = owner[slot + 1]
"""

JACCARD = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format(_TEXT)}, {_SPACED}) AS w FROM documents
),
grams AS (
    SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = doc_id
GROUP BY doc_id
"""

_W, _S = decontaminate.WINDOW, decontaminate.SLACK
DECONTAMINATION = f"""
WITH things AS (
    SELECT item_id, regexp_extract_all({_LOWER.format(_TEXT)}, {_PLAIN}) AS w FROM benchmark
),
cuts AS (
    SELECT item_id, w[i:i + {_W - 1}] AS w
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {_W - 1}, 1) + 1)) AS i FROM things WHERE len(w) > 0)
),
windows AS (SELECT w, list_aggregate(w, 'string_agg', ' ') AS name, list(DISTINCT item_id) AS ids FROM cuts GROUP BY w),
texts AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format(_TEXT)}, {_PLAIN}) AS w,
           regexp_extract_all(lower({_TEXT}), {_PLAIN}) AS loose
    FROM documents
),
lengths AS (SELECT DISTINCT len(w) AS n FROM windows),
places AS (
    SELECT doc_id, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS name
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, lengths)
),
hits AS (SELECT doc_id, i, n, name, ids FROM places JOIN windows USING (name)),
covered AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, unnest(ids)::VARCHAR AS id FROM hits) GROUP BY doc_id
),
tokens AS (SELECT doc_id, unnest(loose) AS term, generate_subscripts(loose, 1) AS spot FROM texts),
counts AS (SELECT term, count(*) AS df FROM tokens GROUP BY term),
ranked AS (
    SELECT name, term, spot, row_number() OVER (PARTITION BY name ORDER BY coalesce(df, 0), spot) AS rare,
           min(coalesce(df, 0)) OVER (PARTITION BY name) AS least
    FROM (SELECT name, lower(unnest(w)) AS term, generate_subscripts(w, 1) AS spot FROM windows) LEFT JOIN counts USING (term)
),
picks AS (SELECT name, term, spot, rare FROM ranked WHERE least > 0 AND rare <= {decontaminate.RAREST}),
starts AS (
    SELECT doc_id, name, tokens.spot - picks.spot AS start FROM tokens JOIN picks USING (term) WHERE rare = 1
),
near AS (
    SELECT DISTINCT doc_id, name, start FROM starts s
    WHERE NOT EXISTS (
        SELECT 1 FROM picks p WHERE p.name = s.name AND rare > 1 AND NOT EXISTS (
            SELECT 1 FROM tokens t
            WHERE t.doc_id = s.doc_id AND t.term = p.term AND t.spot BETWEEN s.start + p.spot - {_S} AND s.start + p.spot + {_S}
        )
    )
),
others AS (
    SELECT doc_id, count(DISTINCT name) AS n_near FROM near
    WHERE (doc_id, name) NOT IN (SELECT (doc_id, name) FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN others USING (doc_id)
"""

LINES = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split({_TEXT}, chr(10))) AS line,
           generate_subscripts(string_split({_TEXT}, chr(10)), 1) AS spot
    FROM documents
),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANK})")} AS key FROM lines),
owners AS (SELECT key, min(doc_id) AS owner FROM keyed GROUP BY key),
judged AS (SELECT *, length(key) < 10 OR doc_id = owner AS stays FROM keyed JOIN owners USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY spot) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_WEIGHTS, _SLOPES, _MAX = list(curriculum.WEIGHTS), list(curriculum.SLOPES), curriculum.MAX_REPEATS
MIXING = f"""
WITH RECURSIVE sizes AS (
    SELECT doc_id, source, len(regexp_extract_all({_TEXT}, {_SPACED}))::BIGINT AS size,
           {_number("doc_id::VARCHAR")} AS mark
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sizes GROUP BY source
),
weighed AS (SELECT *, ({_WEIGHTS})[rank % 3 + 1] AS weight, ({_SLOPES})[rank % 3 + 1]::DOUBLE AS slope FROM sources),
shared(step, rank, full_, target) AS (
    SELECT 0, rank, false, sum(source_size) OVER () * weight / (sum(weight) OVER ()) FROM weighed
    UNION ALL
    SELECT step + 1, rank, over_,
           CASE WHEN over_ THEN {_MAX} * source_size ELSE
               (sum(source_size) OVER () - sum(CASE WHEN over_ THEN {_MAX} * source_size ELSE 0 END) OVER ())
               * weight / (sum(CASE WHEN over_ THEN 0 ELSE weight END) OVER ()) END
    FROM (
        SELECT step, rank, source_size, weight, full_ OR target > {_MAX} * source_size AS over_
        FROM shared JOIN weighed USING (rank) WHERE step < (SELECT count(*) FROM sources)
    )
),
targets AS (
    SELECT w.*, target::DOUBLE AS target FROM shared JOIN weighed w USING (rank)
    WHERE step = (SELECT count(*) FROM sources)
),
demand AS (SELECT sum(target) AS words, sum(target * slope) AS tilt FROM targets),
lined AS (
    SELECT s.*, t.* EXCLUDE (source), floor(t.target)::BIGINT AS asked,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY mark, doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
taken AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE
        (asked // source_size) * size + least(greatest(asked % source_size - start, 0), size) END::BIGINT AS taken,
        least(start / target, 1.0) AS share
    FROM lined
),
timed AS (
    SELECT *, CASE WHEN slope = 0 THEN share ELSE
        (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END AS spot
    FROM taken
)
SELECT doc_id, source, size, source_size, round(target, 6) AS target, taken,
       CASE WHEN taken > 0 THEN round(words * spot + tilt * (spot * spot - spot), 3) END AS position
FROM timed, demand
"""

_PHRASES = ", ".join(f"('{phrase}', '{label}')" for phrase, label in license_scan.PHRASES.items())
_TEMPLATES = ", ".join(f"({n}, '{label}', '{text}')" for n, (label, text) in enumerate(license_scan.TEMPLATES))
_K, _SLACK = license_scan.GRAM, license_scan.SLACK
LICENSES = f"""
WITH phrases(phrase, label) AS (VALUES {_PHRASES}),
templates(template, label, wording) AS (VALUES {_TEMPLATES}),
wordings AS (SELECT template, label, string_split(wording, ' ') AS w FROM templates),
parts AS (
    SELECT template, label, len(w) - {_K - 1} AS grams, i AS spot, list_aggregate(w[i:i + {_K - 1}], 'string_agg', ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - {_K - 2})) AS i FROM wordings)
),
texts AS (SELECT doc_id, regexp_extract_all({_LOWER.format(_TEXT)}, {_PLAIN}) AS w FROM documents),
places AS (
    SELECT doc_id, i - 1 AS start, label
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts) t
    JOIN phrases ON t.w[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')
),
hits AS (
    SELECT doc_id, template, label, grams, i AS place, spot
    FROM (SELECT doc_id, i, list_aggregate(w[i:i + {_K - 1}], 'string_agg', ' ') AS gram
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - {_K - 2})) AS i FROM texts))
    JOIN parts USING (gram)
),
votes AS (
    SELECT doc_id, template, label, grams, place - spot AS diagonal, count(DISTINCT spot) AS votes,
           min(place) AS first, max(place) AS last
    FROM hits GROUP BY ALL
),
marked AS (
    SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {_SLACK}, false) AS fresh
    FROM votes
),
passages AS (
    SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS passage FROM marked
),
merged AS (
    SELECT h.doc_id, h.label, h.grams, min(place) AS first, max(place) + {_K - 1} AS last,
           len(list_reduce(list([place] ORDER BY spot, place DESC),
                           lambda ends, p: list_filter(ends, lambda e: e < p[1]) || p
                                           || ends[len(list_filter(ends, lambda e: e < p[1])) + 2:])) AS run
    FROM hits h JOIN passages d ON h.doc_id = d.doc_id AND h.template = d.template AND place - spot = diagonal
    GROUP BY h.doc_id, h.template, h.label, h.grams, passage
),
spans AS (
    SELECT doc_id, label, run / grams AS cover FROM merged
    WHERE run / grams >= {license_scan.MIN_COVER} AND last - first < grams + {_K - 1 + 2 * _SLACK}
),
base AS (
    SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY doc_id
),
labels AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM spans) GROUP BY doc_id
),
covers AS (SELECT doc_id, max(cover) AS cover FROM spans GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE round(coalesce(cover, 0), 6) END::DOUBLE AS score
FROM texts LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN covers USING (doc_id)
"""

SUFFIXES = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
    SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS w
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM texts WHERE len(h) >= 200)
),
again AS (
    SELECT doc_id, p
    FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS nth FROM windows) WHERE nth > 1
),
marked AS (
    SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, true) AS fresh FROM again
),
runs AS (SELECT doc_id, p, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, run, min(p) AS start, max(p) + 100 AS stop FROM runs GROUP BY doc_id, run),
cuts AS (
    SELECT doc_id, start, stop, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM spans
),
kept AS (
    SELECT doc_id, sum(stop - start) AS n_removed, count(*) AS n_spans, max(stop) AS stop,
           string_agg(substr(h, 2 * before + 1, 2 * (start - before)), '' ORDER BY start) AS head
    FROM cuts JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN head IS NULL THEN h ELSE head || substr(h, 2 * stop + 1) END)) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

_COMMON = quality_rules.COMMON
_LISTS = " ".join(f"WHEN lang = '{name}' THEN {listed}" for name, listed in _COMMON.items())
_CLASS = quality_rules.CLASSES
_COUNTS = ", ".join(
    f"length(t) - length(regexp_replace(t, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g')) AS n_{name}"
    for name, pattern in _CLASS.items()
)
_SHARES = ", ".join(
    f"{x} / chars"
    for x in (
        f"(word_chars - {' - '.join(f'n_{name}' for name in _CLASS)})",
        "(chars - word_chars)",
        *(f"n_{name}" for name in _CLASS),
    )
)
_BINS, _SLOTS = len(_CLASS) + 2, max(map(len, _COMMON.values())) + 1


def _distance(p: str, q: str, n: int) -> str:
    def term(a: str, b: str) -> str:
        return f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"

    parts = [f"(({term(f'{p}[{i}]', f'{q}[{i}]')}) + ({term(f'{q}[{i}]', f'{p}[{i}]')})) / 2" for i in range(1, n + 1)]
    return f"sqrt(greatest({' + '.join(parts)}, 0.0))"


RULES = f"""
WITH texts AS (
    SELECT doc_id, lang, {_TEXT} AS t, regexp_extract_all({_TEXT}, {_SPACED}) AS w,
           [x FOR x IN string_split({_TEXT}, chr(10)) IF regexp_matches(x, {_SPACED})] AS lines,
           CASE {_LISTS} ELSE []::VARCHAR[] END AS listed
    FROM documents
),
grams AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts)
),
again AS (
    SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS spot FROM grams WHERE n > 1)
    GROUP BY doc_id
),
counts AS (
    SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(t) AS chars,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
           [len([x FOR x IN w IF x = c]) FOR c IN listed] AS common, {_COUNTS}
    FROM texts LEFT JOIN again USING (doc_id)
),
shares AS (
    SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           CASE WHEN chars > 0 THEN [{_SHARES}] END AS p,
           CASE WHEN n_words > 0 THEN
               [coalesce(common[i], 0) / n_words FOR i IN range(1, {_SLOTS})]
               || [(n_words - coalesce(list_sum(common), 0)) / n_words] END AS u
    FROM counts
),
means AS (
    SELECT lang, grouping(lang) AS whole, count(*) AS good,
           [{", ".join(f"round(avg(p[{i}]), 9)" for i in range(1, _BINS + 1))}] AS q,
           [{", ".join(f"round(avg(u[{i}]), 9)" for i in range(1, _SLOTS + 1))}] AS v
    FROM shares WHERE NOT base_failed GROUP BY GROUPING SETS ((lang), ())
),
shared AS (SELECT good, q, v FROM means WHERE whole = 1 AND good > 0),
refs AS (
    SELECT l.lang,
           CASE WHEN m.good > 0 THEN [round((m.q[i] * m.good + s.q[i] * {quality_rules.PRIOR}) / (m.good + {quality_rules.PRIOR}), 9)
                                      FOR i IN range(1, {_BINS + 1})] ELSE s.q END AS q,
           CASE WHEN m.good > 0 THEN [round((m.v[i] * m.good + s.v[i] * {quality_rules.PRIOR}) / (m.good + {quality_rules.PRIOR}), 9)
                                      FOR i IN range(1, {_SLOTS + 1})] ELSE s.v END AS v
    FROM (SELECT DISTINCT lang FROM shares) l CROSS JOIN shared s
    LEFT JOIN means m ON m.whole = 0 AND m.lang IS NOT DISTINCT FROM l.lang
),
judged AS (
    SELECT s.*,
           CASE WHEN n_words >= {quality_rules.MIN_WORDS_CLASSES} AND q IS NOT NULL THEN {_distance("p", "q", _BINS)} END AS a,
           CASE WHEN n_words >= {quality_rules.MIN_WORDS_COMMON} AND len(common) > 0 AND v IS NOT NULL
                THEN {_distance("u", "v", _SLOTS)} END AS b
    FROM shares s LEFT JOIN refs m ON s.lang IS NOT DISTINCT FROM m.lang
)
SELECT doc_id, n_words, word_chars, n_symbol::BIGINT AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(a, 6) AS class_distance, round(b, 6) AS common_distance,
       NOT base_failed AND coalesce(round(a, 6), 0) <= {quality_rules.MAX_CLASS_DISTANCE}
       AND coalesce(round(b, 6), 0) <= {quality_rules.MAX_COMMON_DISTANCE} AS kept
FROM judged
"""

ORACLE: dict[str, str] = {
    "op1_sharding": SHARDING,
    "op2_ngram_jaccard_join": JACCARD,
    "op3_decontamination": DECONTAMINATION,
    "op4_line_dedup": LINES,
    "op6_mixing": MIXING,
    "op8_license_scans": LICENSES,
    "op9_quality_rules": RULES,
    "op10_suffix_array_dedup": SUFFIXES,
    "op11_conversation_repair": CONVERSATIONS,
    "op13_html_extraction": PAGES,
}
