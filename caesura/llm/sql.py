"""SQL for DuckDB of the queries here that SQL can express on whole tables."""

from __future__ import annotations

from caesura.llm import divergence as D

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAPS = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{GAPS}'), lambda x: x <> '')"


NGRAM_JOIN = f"""WITH RECURSIVE w AS (SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS d, doc_id AS z FROM documents UNION SELECT r.d, e.y FROM r JOIN e ON r.z = e.x),
m AS (SELECT d, min(z) AS z FROM r GROUP BY 1)
SELECT o.doc_id, coalesce(n.n, 0) AS n_shingles, m.z AS component_id FROM documents o JOIN m ON m.d = o.doc_id LEFT JOIN n ON n.doc_id = o.doc_id"""


def _quoted(chars: str) -> str:
    return "".join("\\" + c if c in "[]\\^-" else "''" if c == "'" else c for c in chars)


def _count(text: str, members: str) -> str:
    return f"(len({text}) - len(regexp_replace({text}, '[{members}]', '', 'g')))"


def _classes(text: str) -> list[str]:
    """Characters by class; MARKS are punctuation by category, and symbols here."""
    counts, marks = [_count(text, "".join(rf"\p{{{x}}}" for x in members)) for members in D.CLASSES], _count(text, _quoted(D.MARKS))
    rest = f"len({text}) - ({' + '.join(counts)})"
    counts[D.PUNCTUATION] += f" - {marks}"
    counts[D.SYMBOL] += f" + {marks}"
    return [*counts, rest]


def _kinds(text: str) -> list[str]:
    counts = _classes(text)
    return [" + ".join(counts[: D.LETTERS + 1]), *counts[D.LETTERS + 1 :]]


SYMBOLS = _count("t", _quoted(D.SYMBOLS.decode()))


def _distance(table: str) -> str:
    """Jensen-Shannon's distance of counts `own` and `ref` by document and term."""
    half = "CASE WHEN {a} > 0 THEN {a} * log2({a} / ((p + q) / 2)) ELSE 0 END"
    return f"(SELECT doc_id, sqrt(greatest(sum(({half.format(a='p')} + {half.format(a='q')}) / 2), 0)) AS d FROM (SELECT doc_id, own / sum(own) OVER (PARTITION BY doc_id) AS p, ref / sum(ref) OVER (PARTITION BY doc_id) AS q FROM {table}) GROUP BY 1)"


def _histogram(name: str, counts: list[str]) -> str:
    """A row a document and class, and its language's sums."""
    return f"""h{name} AS (SELECT doc_id, lang, n_words, word_chars, base_failed, unnest(range({len(counts)})) AS term, unnest([{', '.join(counts)}]) AS own FROM f),
r{name} AS (SELECT lang, term, sum(own)::DOUBLE AS ref FROM h{name} WHERE NOT base_failed GROUP BY ALL)"""


DIVERGENCE = f"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) AS x FROM d WHERE len(ws) >= 3),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM g),
v AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM k WHERE c > 1) GROUP BY 1),
b AS (SELECT d.doc_id, lang, len(ws) AS n_words, array_to_string(ws, '') AS j, array_to_string(list_transform(ws, lambda x: substring(x, 1, 1)), '') AS heads, translate(array_to_string(ws, ' '), '{UPPER}', '{UPPER.lower()}') AS low, {SYMBOLS} AS n_symbols, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls, coalesce(v.n, 0) AS n_repeat_words FROM d LEFT JOIN v USING (doc_id)),
f AS (SELECT *, len(j) AS word_chars, len(ls) - len(list_distinct(ls)) AS n_dup_lines, n_words < {D.MIN_WORDS} OR 100 * n_repeat_words > {D.MAX_REPEATED} * n_words AS base_failed FROM b),
l AS (SELECT lang, count(*) >= {D.MIN_REFERENCE} AS known FROM f WHERE NOT base_failed GROUP BY 1),
u AS (SELECT doc_id, lang, unnest(string_split(low, ' ')) AS term FROM f),
c AS (SELECT doc_id, lang, term, count(*) AS own FROM u WHERE regexp_full_match(term, '[\\p{{L}}\\p{{M}}]+') GROUP BY ALL),
z AS (SELECT lang, term FROM (SELECT lang, term, count(*) AS n FROM c GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) <= {D.N_COMMON}),
hw AS (SELECT f.doc_id, f.lang, n_words, base_failed, z.term, coalesce(own, 0) AS own FROM f JOIN z ON z.lang IS NOT DISTINCT FROM f.lang LEFT JOIN c ON c.doc_id = f.doc_id AND c.term = z.term
  UNION ALL SELECT f.doc_id, f.lang, n_words, base_failed, '', n_words - coalesce((SELECT sum(own) FROM c JOIN z ON z.term = c.term AND z.lang IS NOT DISTINCT FROM c.lang WHERE c.doc_id = f.doc_id), 0) FROM f),
rw AS (SELECT lang, term, sum(own)::DOUBLE AS ref FROM hw WHERE NOT base_failed GROUP BY ALL),
jw AS (SELECT doc_id, own::DOUBLE AS own, ref FROM hw JOIN rw ON hw.term = rw.term AND hw.lang IS NOT DISTINCT FROM rw.lang JOIN l ON l.lang IS NOT DISTINCT FROM hw.lang AND known WHERE n_words >= {D.MIN_WORDS}),
{_histogram("c", _classes("j"))},
jc AS (SELECT doc_id, own::DOUBLE AS own, ref FROM hc JOIN rc ON hc.term = rc.term AND hc.lang IS NOT DISTINCT FROM rc.lang JOIN l ON l.lang IS NOT DISTINCT FROM hc.lang AND known WHERE word_chars >= {D.MIN_CHARS}),
{_histogram("k", _kinds("heads"))},
jk AS (SELECT doc_id, own::DOUBLE AS own, CASE WHEN known THEN rk.ref ELSE e.ref END AS ref FROM hk JOIN (SELECT term, sum(ref) AS ref FROM rk GROUP BY 1) e ON e.term = hk.term LEFT JOIN rk ON hk.term = rk.term AND hk.lang IS NOT DISTINCT FROM rk.lang LEFT JOIN l ON l.lang IS NOT DISTINCT FROM hk.lang WHERE n_words >= {D.MIN_WORDS})
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(x.d <= {D.MAX_CLASS}, true) AND coalesce(k.d <= {D.MAX_KIND}, true) AND coalesce(y.d <= {D.WORD_LIMIT[0]} + {D.WORD_LIMIT[1]} / sqrt(n_words), true) AS kept, round(x.d, 4) AS class_distance, round(k.d, 4) AS kind_distance, round(y.d, 4) AS word_distance
FROM f LEFT JOIN {_distance('jc')} x ON x.doc_id = f.doc_id LEFT JOIN {_distance('jk')} k ON k.doc_id = f.doc_id LEFT JOIN {_distance('jw')} y ON y.doc_id = f.doc_id"""

ORACLES = {"op1_distribution_divergence": DIVERGENCE, "op2_ngram_jaccard": NGRAM_JOIN}
