"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import fill_in_middle as fim, hard_negatives as neg
from .near_dedup import PERCENT
from .quality_rules import LENGTH, MEASURES, RATES, SHRINK, SPREAD, TAIL_JUNK

_SPLIT = r"regexp_split_to_array({}, '[\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter({_SPLIT.format(f"coalesce({text}, '')")}, lambda w: w <> '')"


def _shingles(words: str, width: int) -> str:
    return f"list_distinct(list_transform(range(1, len({words}) - {width} + 2), lambda i: {words}[i:i + {width - 1}]))"


OP3 = f"""
WITH d AS (SELECT doc_id, {_words('lower(text)')} AS w FROM documents),
i AS (SELECT item_id, {_words('lower(text)')} AS w FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 5) AS k FROM i WHERE len(w) > 0),
ds AS (SELECT doc_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1]))) AS s
       FROM d JOIN sizes ON len(w) >= k),
items AS (SELECT item_id, least(len(w), 5) AS k,
                 list_distinct(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: w[i:i + least(len(w), 5) - 1])) AS s
          FROM i WHERE len(w) > 0),
found AS (SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_shingles, CAST(count(*) AS BIGINT) AS n_shared
          FROM (SELECT item_id, k, len(s) AS n, unnest(s) AS s FROM items) JOIN ds USING (k, s)
          GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n)
SELECT * FROM found"""


def _rules() -> str:
    value = {m.name: f"CASE WHEN {m.bottom} > 0 THEN (1000 * {m.top}) // {m.bottom} ELSE 0 END" for m in MEASURES}
    drop = "greatest(length(bin(v)) - 6, 0)"
    one = "SELECT lang, source, '{}' AS measure, CAST({} AS BIGINT) AS v FROM c WHERE NOT base_failed"
    pairs = " UNION ALL ".join(
        [one.format(m.name, value[m.name]) for m in MEASURES]
        + [one.format(f"@{m.name}", value[LENGTH.name]) + f" AND {value[m.name]} > 0" for m in RATES])
    width = lambda outer, middle: f"greatest({SPREAD} * abs({outer} - {middle}), {outer} // 8 + 1)"

    def level(name: str, keys: str) -> str:
        by = f"{keys}, measure" if keys else "measure"
        on = f"USING ({keys})" if keys else "ON true"
        return f"""{name}_q AS (
  SELECT {by}, max(total) AS total, min(CASE WHEN 4 * upto >= total THEN b END) AS q1,
         min(CASE WHEN 4 * upto >= 2 * total THEN b END) AS q2, min(CASE WHEN 4 * upto >= 3 * total THEN b END) AS q3
  FROM (SELECT {by}, b, sum(n) OVER (PARTITION BY {by} ORDER BY b) AS upto, sum(n) OVER (PARTITION BY {by}) AS total
        FROM (SELECT {by}, b, count(*) AS n FROM st GROUP BY ALL)) GROUP BY {by}),
{name}_o AS (
  SELECT {keys + ',' if keys else ''} '+' || substr(s.measure, 2) AS measure,
         (1000 * count_if(b > q3 + {width('q3', 'q2')} OR b < q1 - {width('q1', 'q2')})) // count(*) AS out
  FROM s JOIN (SELECT * EXCLUDE (measure) FROM {name}_q WHERE measure = '{LENGTH.name}') {on} WHERE s.measure[1] = '@' GROUP BY ALL),
{name} AS (SELECT * FROM {name}_q LEFT JOIN {name}_o USING ({by}))"""

    def lean(own: str, wider: str) -> str:
        return ", ".join(f"CASE WHEN {own}.total IS NULL THEN {wider}.{q} WHEN {wider}.{q} IS NULL THEN {own}.{q} "
                         f"ELSE ({own}.total * {own}.{q} + {SHRINK} * {wider}.{q}) // ({own}.total + {SHRINK}) END AS {q}"
                         for q in ("q1", "q2", "q3", "out"))

    names = ", ".join(f"('{n}')" for n in [*[m.name for m in MEASURES], *[f"+{m.name}" for m in RATES]])
    get = lambda name, q: f"max(CASE WHEN measure = '{name}' THEN {q} END)"
    up = lambda name: f"({get(name, 'q3')} + {width(get(name, 'q3'), get(name, 'q2'))})"
    low = f"{get(LENGTH.name, 'q1')} - {width(get(LENGTH.name, 'q1'), get(LENGTH.name, 'q2'))}"
    highs = ", ".join(
        f"CASE WHEN {get(m.name, 'q2')} > 0 THEN {up(m.name)} ELSE coalesce(CASE WHEN {get('+' + m.name, 'out')} > {TAIL_JUNK} "
        f"THEN {get('+' + m.name, 'q1')} // 2 ELSE {up('+' + m.name)} END, 0) END AS high_{m.name}" for m in RATES)
    fits = " AND ".join([f"{value[m.name]} <= f.high_{m.name}" for m in MEASURES] + [f"{value[LENGTH.name]} >= f.low"])
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '~') AS lang, coalesce(source, '~') AS source,
                  coalesce(text, '') AS text, {_words('text')} AS words FROM documents),
t AS (SELECT r, unnest(range(1, len(words) - 1)) AS pos, words FROM w WHERE len(words) >= 3),
twice AS (SELECT r, pos, count(*) OVER (PARTITION BY r, words[pos], words[pos + 1], words[pos + 2]) AS n FROM t),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([pos, pos + 1, pos + 2]) AS p FROM twice WHERE n > 1) GROUP BY r),
l AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: len(list_filter({_SPLIT.format('x')}, lambda y: y <> '')) > 0) AS lines FROM w),
c AS (SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             len(words) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(words) AS base_failed
      FROM w JOIN l USING (r) LEFT JOIN rep USING (r)),
m AS ({pairs}),
s AS (SELECT lang, source, measure, (v >> {drop}) << {drop} AS b FROM m),
st AS (SELECT * FROM s WHERE measure[1] <> '@'
       UNION ALL SELECT lang, source, '+' || measure, b FROM s WHERE measure IN ({', '.join(f"'{m.name}'" for m in RATES)}) AND b > 0),
{level('whole', '')},
{level('bylang', 'lang')},
{level('own', 'lang, source')},
names AS (SELECT col0 AS measure FROM (VALUES {names})),
ll AS (SELECT l.lang, names.measure, {lean('bylang', 'whole')} FROM (SELECT DISTINCT lang FROM s) l CROSS JOIN names
       LEFT JOIN bylang ON bylang.lang = l.lang AND bylang.measure = names.measure LEFT JOIN whole ON whole.measure = names.measure),
gg AS (SELECT g.lang, g.source, names.measure, {lean('own', 'll')} FROM (SELECT DISTINCT lang, source FROM s) g CROSS JOIN names
       LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.measure = names.measure
       LEFT JOIN ll ON ll.lang = g.lang AND ll.measure = names.measure),
f AS (SELECT lang, source, {low} AS low, {up(LENGTH.name)} AS high_{LENGTH.name}, {highs} FROM gg GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({fits}, false) AS kept
FROM c LEFT JOIN f USING (lang, source)"""


OP4 = _rules()

_CHUNK = "CAST('0x' || h[{0}:{0} + 4] AS INTEGER)"
_BASE32 = " || ".join(
    f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(({_CHUNK.format(5 * k + 1)} >> {shift}) & 31) + 1]"
    for k in range(8) for shift in (15, 10, 5, 0))

OP6 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to FROM p"""

OP9 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(_LOWER.format('text'))} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w] ELSE {_shingles('w', 2)} END AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.s = b.s AND a.doc_id < b.doc_id
      AND a.n * 100 >= {PERCENT} * b.n AND b.n * 100 >= {PERCENT} * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""


OP11 = f"""
WITH u AS (
  SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor({neg.SCALE} * CAST(c AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.r AS ar, a.id AS anchor_id, b.r AS br, b.id AS id, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM u a, u b WHERE a.id % {neg.ANCHOR_EVERY} = 0 AND a.r <> b.r),
p AS (SELECT ar, anchor_id, br AS pr, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) <= {neg.POSITIVES}),
n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY s.score DESC, s.id, s.br) AS INTEGER) AS rank
      FROM p JOIN s ON p.ar = s.ar AND NOT s.same
       AND {neg.LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {neg.HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {neg.NEGATIVES}"""

_DRAW = "CAST('0x' || h[{0}:{0} + 7] AS BIGINT)"
_MARKS = (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)

OP12 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{fim.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM d),
c AS (SELECT *, len(u) AS n, {_DRAW.format(1)} % (len(u) + 1) AS c1, {_DRAW.format(9)} % (len(u) + 1) AS c2,
             CASE WHEN text = '' OR {' OR '.join(f"contains(text, '{m}')" for m in _MARKS)} OR {_DRAW.format(17)} % 100 >= {fim.FIM_PERCENT}
                  THEN 'plain' WHEN {_DRAW.format(25)} % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM t),
x AS (SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
             array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{fim.PREFIX}' || p || '{fim.SUFFIX}' || s || '{fim.MIDDLE}' || m
              ELSE '{fim.SUFFIX}' || s || '{fim.PREFIX}' || p || '{fim.MIDDLE}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM x"""
