"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from arrears.llm.risk_rules import GRID, RULES, Risk

TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.r <> q.r AND len(q.v) = len(c.v)
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _ratio(name: str) -> str:
    """A rule's ratio in double arithmetic, zero without words."""
    sql = RULES[name].replace("n_symbols", "CAST(n_symbols AS DOUBLE)").replace("n_repeat_words", "CAST(n_repeat_words AS DOUBLE)")
    sql = sql.replace("n_dup_lines", "CAST(n_dup_lines AS DOUBLE)").replace("word_chars / n_words", "CAST(word_chars AS DOUBLE) / n_words")
    return f"CASE WHEN n_words > 0 THEN {sql} ELSE 0.0 END"


def risk_rules(risk: Risk = Risk()) -> str:
    rate = risk.alpha / len(RULES)
    tries = " UNION ALL ".join(f"SELECT stratum, good, '{name}' AS rule, {_ratio(name)} AS ratio FROM held" for name in RULES)
    grid = ", ".join(f"({c})" for c in GRID)
    limits = ", ".join(f"max(CASE WHEN rule = '{name}' THEN cutoff END) AS c_{name}" for name in RULES)
    broken = " OR ".join(f"coalesce(({_ratio(name)}) > c_{name}, false)" for name in RULES)
    return f"""
WITH t AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (
    SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
    FROM t
),
g AS (SELECT r, i, w[i : i + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
c AS (
    SELECT r, sum(least(5, coalesce(following - i, 5))) AS n
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM d) GROUP BY r
),
s AS (
    SELECT doc_id, stratum, t, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN c USING (r)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s),
q AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
held AS (
    SELECT stratum, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
           any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words, min(good) AS good
    FROM b JOIN q USING (doc_id) WHERE NOT base_failed GROUP BY stratum, t
),
tries AS ({tries}),
tests AS (
    SELECT stratum, rule, cutoff, sum(good) AS n, sum(CASE WHEN ratio > cutoff THEN good ELSE 0 END) AS lost,
           sum(CASE WHEN ratio > cutoff THEN 1 - good ELSE 0 END) AS caught
    FROM tries CROSS JOIN (SELECT CAST(c AS DOUBLE) AS cutoff FROM (VALUES {grid}) AS v(c)) GROUP BY stratum, rule, cutoff
),
level AS (SELECT {risk.delta / len(RULES)} / greatest(count(DISTINCT coalesce('=' || stratum, '')), 1) AS level FROM tests),
tested AS (
    SELECT stratum, rule, cutoff, caught - {risk.worth} * lost AS gain, CASE WHEN lost >= n * {rate} THEN 1.0 ELSE list_sum(list_transform(range(0, CAST(lost + 1 AS BIGINT)), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))) END > level AS fails
    FROM tests CROSS JOIN level
),
safe AS (SELECT * FROM (SELECT *, bool_or(fails) OVER (PARTITION BY stratum, rule ORDER BY cutoff DESC) AS failed FROM tested) WHERE NOT failed),
best AS (SELECT stratum, rule, arg_max(cutoff, gain + cutoff) AS cutoff FROM safe WHERE gain > 0 GROUP BY stratum, rule),
limits AS (SELECT stratum, true AS found, {limits} FROM best GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (found IS NOT NULL AND ({broken})) AS kept
FROM b LEFT JOIN limits ON b.stratum IS NOT DISTINCT FROM limits.stratum
"""


def crc32(codes: str) -> str:
    """Unsigned CRC-32 of a list of byte values, bit by bit."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: {bit})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {byte}), CAST(4294967295 AS BIGINT))"


#: Byte values of a string whose code points are below 256.
_BYTES = (
    "flatten(list_transform(string_split({s}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] "
    "ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))"
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPELLING = f"""
WITH RECURSIVE
r AS (
    SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY 1, 2
),
h AS (SELECT *, {crc32(_BYTES.format(s="coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"))} AS h FROM r),
o AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM o WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(0, length(word))) AS i FROM v)),
pairs AS (
    SELECT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word
    UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word
),
best AS (SELECT word, count(*) AS n_near, min({{'less': -n, 'near': near}}) AS best FROM pairs GROUP BY word),
f AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * v.n THEN best.near END AS form,
           CASE WHEN -best.less >= 5 * v.n THEN -best.less END AS form_n
    FROM v LEFT JOIN best USING (word)
),
chain AS (
    SELECT word, word AS reached, 0 AS steps FROM f
    UNION ALL SELECT chain.word, f.form, steps + 1 FROM chain JOIN f ON f.word = chain.reached WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, roots.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n FROM f JOIN roots USING (word)
"""


def _climb(name: str, group: str, leaves: str, levels: int) -> tuple[str, str, str]:
    """CTEs of the runs of every level above ``leaves`` ({group}, pos, h), joins of a row ``x`` to all of them, and the top."""
    ctes, joins = [], []
    nodes = leaves
    for i in range(levels):
        ctes.append(
            f"{name}r{i} AS (SELECT {group}, pos // 8 AS run, list(h ORDER BY pos) AS hs, sum(count(*)) OVER (PARTITION BY {group}) > 1 AS several FROM {nodes} GROUP BY {group}, pos // 8)"
        )
        ctes.append(f"{name}n{i + 1} AS (SELECT {group}, run AS pos, CASE WHEN several THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{i})")
        joins.append(f"JOIN {name}r{i} ON {name}r{i}.{group} IS NOT DISTINCT FROM x.{group} AND {name}r{i}.run = x.pos // {8 ** (i + 1)}")
        nodes = f"{name}n{i + 1}"
    return ",\n".join(ctes), " ".join(joins), nodes


def merkle(levels: int = 12) -> str:
    """Fan-out eight with twelve levels, enough for 8 ** 12 rows of a language."""
    value = "coalesce(CAST(octet_length(CAST(encode(CAST({c} AS VARCHAR)) AS BLOB)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    columns = ["doc_id", "source", "lang", "n_chars"]
    head = " || ".join(value.format(c=c) for c in columns)
    changed = value.format(c=f"CASE WHEN tampered THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END")

    def several(name: str, i: int) -> str:
        # A level has several nodes if its runs do or the only run holds more than one.
        return f"({name}r{i}.several OR len({name}r{i}.hs) > 1)"

    def sides(name: str, i: int) -> str:
        slot = f"CAST((x.pos // {8**i}) % 8 AS BIGINT)"
        return f"CASE WHEN {several(name, i)} THEN [{{'l': array_to_string({name}r{i}.hs[1 : {slot}], ''), 'r': array_to_string({name}r{i}.hs[{slot} + 2 :], '')}}] ELSE [] END"

    def tree(name: str, group: str, leaves: str) -> str:
        ctes, joins, top = _climb(name, group, leaves, levels)
        ctes = ctes.replace("CASE WHEN several THEN", "CASE WHEN several OR len(hs) > 1 THEN")
        path = " || ".join(sides(name, i) for i in range(levels))
        return f"{ctes},\n{name}p AS (SELECT x.*, t.h AS top, {path} AS path FROM {leaves} x {joins} JOIN {top} t ON t.{group} IS NOT DISTINCT FROM x.{group})"

    return f"""
WITH t AS (SELECT *, doc_id IS NOT NULL AND {crc32(_BYTES.format(s="CAST(doc_id AS VARCHAR)"))} % 3 = 0 AS tampered FROM documents),
l AS (SELECT doc_id, lang AS grp, sha256({head} || {value.format(c="text")}) AS h, sha256({head} || {changed}) AS now FROM t),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM l),
{tree("a", "grp", "leaves")},
subroots AS (SELECT grp, top AS h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, true AS one FROM ap WHERE pos = 0),
{tree("b", "one", "subroots")},
w AS (SELECT ap.doc_id, ap.h AS leaf, ap.now, ap.top AS subroot, bp.top AS root, ap.path || bp.path AS path FROM ap JOIN bp ON ap.grp IS NOT DISTINCT FROM bp.grp),
f AS (
    SELECT *, list_reduce(list_prepend({{'l': now, 'r': ''}}, path), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root FROM w
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM f
"""


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
k AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
s AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM k)),
g AS (
    SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN (SELECT DISTINCT k FROM k) ON len(w) >= k)
),
m AS (SELECT DISTINCT r, g.k, i, item_id FROM g JOIN s ON g.k = s.k AND g.s = s.s),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
n AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""
