"""SQL for DuckDB that computes the registered queries another way: row by row, with range joins and window functions."""

from __future__ import annotations

from caesura.functions.text import BOUNDARY_TYPES, STUDENT_LABELS
from caesura.operators.training import HEADER
from caesura.plans.queries import OVERLAY, WEIGHTS

WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
REFERENCE = r"^\([^)]*(?:요|마|막|눅|롬|고전|고후|창|출|시|사)[^)]*[0-9][^)]*\)$"


def _norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def _overlay(i: str, text: str) -> str:
    return f"CASE {i} % 17 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in OVERLAY.items()) + f" ELSE {text} END"


def _cut(text: str, ends: str) -> str:
    return f"list_filter(string_split(regexp_replace({text}, '([{ends}]) ', '\\1' || chr(31), 'g'), chr(31)), lambda x: len(trim(x)) >= 2)"


def _pieces(text: str) -> str:
    return f"string_split(regexp_replace({text}, '([.!?。！？]) ', '\\1' || chr(31), 'g'), chr(31))"


def _label(t: str) -> str:
    return f"CASE WHEN trim({t}) = '' THEN 'none' WHEN {t} IN ('기도하겠습니다.', '아멘.', '아멘') OR ends_with({t}, '기도합니다.') THEN 'prayer_or_closing' WHEN starts_with({t}, 'Chapter ') OR starts_with({t}, '제') THEN 'topic_shift' WHEN regexp_matches({t}, '{REFERENCE}') OR contains({t}, '다음과 같이 표현합니다') THEN 'scripture_reading_start' ELSE 'none' END"


def _split(x: str) -> str:
    """sha1 mod 10 by long division, digit by digit."""
    return f"(SELECT CASE WHEN b < 8 THEN 'train' WHEN b = 8 THEN 'validation' ELSE 'test' END FROM (SELECT list_reduce(list_prepend(0::BIGINT, list_transform(string_split(sha1({x}), ''), lambda d: (instr('0123456789abcdef', d) - 1)::BIGINT)), lambda a, d: (a * 16 + d) % 10) AS b))"


DOCX = "'docx.' || substr(sha1('datas/docx/' || doc_id), 1, 12)"
SENTENCES = f"""
line AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS b FROM documents),
block AS (SELECT doc_id, source, b, {_norm('raw')} AS t FROM line WHERE {_norm('raw')} <> ''),
cut AS (SELECT doc_id, source, b, CASE WHEN len({_pieces('t')}) = 1 AND len(t) > 450 THEN {_cut('t', '다요죠까라니함됨음')} ELSE {_cut('t', '.!?。！？')} END AS p FROM block),
piece AS (SELECT doc_id, source, b, unnest(p) AS t, generate_subscripts(p, 1) AS k FROM cut WHERE len(p) > 0),
plain AS (SELECT doc_id, source, 'hwp.' || substr(sha1('documents/' || doc_id), 1, 12) AS document_id, trim(t) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY b, k) - 1 AS p FROM piece),
sentence AS (SELECT doc_id, source, document_id, p, {_overlay('p', 't')} AS text, document_id || printf('.s%04d', p) AS sentence_id, count(*) OVER (PARTITION BY doc_id) AS n FROM plain)"""


def _shown(target: int, left: int, right: int) -> str:
    """Window members by a range join of windows and sentences."""
    return f"""{SENTENCES},
size AS (SELECT DISTINCT document_id, n FROM sentence),
span AS (SELECT document_id, n, w, w * {target} AS ts, least(w * {target} + {target}, n) AS te, greatest(0, w * {target} - {left}) AS vs, least(n, least(w * {target} + {target}, n) + {right}) AS ve FROM size, LATERAL (SELECT unnest(range((n + {target} - 1) // {target})) AS w)),
every AS (SELECT s.document_id, printf('teacher:%s:w%04d:%d-%d', s.document_id, w, ts, te) AS custom_id, w, ts, te, vs, ve, x.p, x.sentence_id, x.text, 'S' || (x.p - vs + 1) AS sid, x.p - vs + 1 AS num, x.p >= ts AND x.p < te AS is_target, x.p >= ts AND x.p < te AND x.p + 1 < ve AS candidate FROM span s JOIN sentence x ON x.document_id = s.document_id AND x.p >= vs AND x.p < ve),
shown AS (SELECT *, {_label('text')} AS label FROM (SELECT *, bool_or(candidate) OVER (PARTITION BY custom_id) AS live FROM every) WHERE live)"""


W = _shown(20, 3, 3)
LABELS = ", ".join(f"'{x}'" for x in STUDENT_LABELS)
HEAD = " || chr(10) || ".join(f"'{x}'" for x in HEADER)
EXAMPLE = f"""{W},
example AS (SELECT custom_id, document_id, w, {HEAD} || chr(10) || string_agg('<' || sid || '> ' || text, chr(10) ORDER BY num) AS input,
  coalesce(string_agg(CASE WHEN label <> 'none' THEN sid || ' ' || label END, chr(10) ORDER BY num), 'NO_BOUNDARY') AS sparse, coalesce(arg_min(sid || ' ' || label, num) FILTER (WHERE label <> 'none'), 'NO_BOUNDARY') AS first,
  list(sid ORDER BY num) AS sids, count(*) FILTER (WHERE label <> 'none') AS n_lines
  FROM shown WHERE candidate GROUP BY ALL)"""
GOLD = f"""{W},
win AS (SELECT custom_id, w, count(*) AS n FROM shown GROUP BY ALL),
gold AS (SELECT custom_id, w, num::BIGINT AS g FROM shown WHERE candidate AND label <> 'none'),
pred AS (SELECT DISTINCT custom_id, g FROM (SELECT custom_id, CASE WHEN (g * 7 + w) % 5 = 1 THEN g + 1 ELSE g END AS g FROM gold WHERE (g * 7 + w) % 5 <> 0 UNION ALL SELECT custom_id, num AS g FROM shown WHERE candidate AND (num * 11 + w) % 13 = 0)),
duo AS (SELECT custom_id, n, w, coalesce((SELECT list(g ORDER BY g) FROM gold x WHERE x.custom_id = win.custom_id), []) AS gs, coalesce((SELECT list(g ORDER BY g) FROM pred x WHERE x.custom_id = win.custom_id), []) AS ps FROM win)"""


def _f1(tp: str, g: str, p: str) -> str:
    return f"round(CASE WHEN {g} = 0 AND {p} = 0 THEN 1.0 WHEN {tp} = 0 THEN 0.0 ELSE 2.0 * {tp} / ({g} + {p}) END, 6)::DOUBLE"


def _script(chars: str) -> str:
    return f"len(regexp_replace(line, '[^{chars}]', '', 'g'))"


SCRIPT = {"hangul": r"\x{ac00}-\x{d7af}\x{1100}-\x{11ff}\x{3130}-\x{318f}", "han": r"\x{4e00}-\x{9fff}", "latin": r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}", "greek": r"\x{370}-\x{3ff}", "hebrew": r"\x{590}-\x{5ff}"}
CUE = {"cue:starts_je": "starts_with(text, '제')", "cue:starts_chapter": "starts_with(lower(text), 'chapter ')", **{f"cue:contains:{c}": f"contains(text, '{c}')" for c in ("기도", "아멘", "다음과 같이 표현합니다", "말씀", "본문")}}
VALUE = {"bias": "1", "len_bucket:10": "CASE WHEN len(text) // 20 >= 10 THEN 1 ELSE 0 END", "char:(": "least(4, len(substr(text, 1, 96)) - len(replace(substr(text, 1, 96), '(', '')))", "bigram:en": "least(3, len(list_filter(range(1, least(len(substr(text, 1, 96)) - 1, 48) + 1), lambda i: substr(text, i, 2) = 'en')))", **{k: f"CASE WHEN {v} THEN 1 ELSE 0 END" for k, v in CUE.items()}}
SCORE = {label: " + ".join(f"{w} * ({VALUE[f]})" for l, f, w in WEIGHTS if l == label) or "0" for label in BOUNDARY_TYPES}
FAULT = "CASE w % 6 WHEN 1 THEN sparse || chr(10) || 'S2 none' || chr(10) || 'bad' || chr(10) || 'SX topic_shift' || chr(10) || 'S999 topic_shift' WHEN 2 THEN 'S3 topic_shift' || chr(10) || chr(10) || 'S2 topic_shift' || chr(10) || '  ' || chr(10) || 'S2 topic_shift' || chr(10) || sparse WHEN 3 THEN '  ' ELSE sparse END"

ORACLES = {
    "normalize_text": f"SELECT doc_id, len({_norm('text')})::BIGINT AS n, md5({_norm('text')}) AS digest FROM documents",
    "block_filters": f"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
o AS (SELECT CASE WHEN i % 9 = 4 THEN '12' WHEN i % 9 = 7 THEN ' • ' ELSE {_overlay('i', 'line')} END AS line FROM l),
c AS (SELECT line, {', '.join(f'{_script(v)} AS n_{k}' for k, v in SCRIPT.items())} FROM o),
r AS (SELECT *, CASE WHEN n_hangul >= 2 THEN 'hangul_present' WHEN regexp_matches(line, '\\([^)]+[0-9]+[:：][0-9]+') THEN 'scripture_reference_or_short_context' WHEN n_hangul = 0 AND n_han >= 2 THEN 'han_dominant_foreign' WHEN n_hangul = 0 AND n_latin >= 20 THEN 'latin_dominant_foreign' ELSE 'no_korean_signal' END AS reason FROM c)
SELECT reason, reason IN ('hangul_present', 'scripture_reference_or_short_context') AS kept, count(*) AS n_lines, count(*) FILTER (WHERE {_norm('line')} = '' OR regexp_full_match({_norm('line')}, '[0-9]{{1,3}}') OR {_norm('line')} IN ('•', '-', '—', '_')) AS n_noise, {', '.join(f'sum(n_{k})::BIGINT AS n_{k}' for k in SCRIPT)} FROM r GROUP BY 1, 2""",
    "document_kinds": f"SELECT doc_id, 'docx.' || substr(sha1('datas/docx/' || doc_id), 1, 12) AS document_id, CASE doc_id % 5 WHEN 0 THEN 'sermon' WHEN 1 THEN 'prayer' WHEN 2 THEN 'thesis' WHEN 3 THEN 'notice' ELSE 'prayer' END AS kind, {_split(DOCX)} AS split FROM documents",
    "sentence_rows": f"WITH {SENTENCES} SELECT document_id, sentence_id, p::BIGINT AS sentence_index, text FROM sentence",
    "sentence_cap": f"WITH {SENTENCES} SELECT document_id, count(*) AS n, max(sentence_id) AS last_id FROM sentence WHERE p < 5 GROUP BY 1",
    "dataset_summary": f"WITH {SENTENCES}, d AS (SELECT o.source, coalesce(s.n, 0) AS n FROM documents o LEFT JOIN (SELECT doc_id, count(*) AS n FROM sentence GROUP BY 1) s USING (doc_id)) SELECT source, count(*) AS total, count(*) FILTER (WHERE n > 0) AS succeeded, count(*) FILTER (WHERE n = 0) AS failed, sum(n)::BIGINT AS n_sentences FROM d GROUP BY ROLLUP (source)",
    "window_sizes": f"WITH {_shown(160, 20, 20)} SELECT document_id, count(DISTINCT custom_id) AS n_windows, count(*) AS n_visible, count(*) FILTER (WHERE candidate) AS n_targets FROM shown GROUP BY 1",
    "window_rows": f"WITH {W} SELECT custom_id, document_id, w::BIGINT AS window_index, ts::BIGINT AS target_start, te::BIGINT AS target_end, vs::BIGINT AS visible_start, ve::BIGINT AS visible_end, string_agg(CASE WHEN candidate THEN sid END, ',' ORDER BY num) AS target_sids, md5(string_agg('<' || sid || '> ' || text, chr(10) ORDER BY num)) AS anchored_md5 FROM shown GROUP BY ALL",
    "window_sentences": f"WITH {W} SELECT custom_id, sid AS local_sid, sentence_id AS source_sentence_id, p::BIGINT AS position, CASE WHEN is_target THEN 'target' ELSE 'context' END AS role, candidate FROM shown",
    "window_limit": f"WITH {W} SELECT custom_id FROM (SELECT DISTINCT document_id, w, custom_id FROM shown) ORDER BY document_id, w LIMIT 25",
    "rule_labels": f"WITH {W} SELECT label AS boundary_type, count(*) AS n, count(*) FILTER (WHERE label <> 'none') AS n_split, round(avg(CASE WHEN label <> 'none' THEN 0.35 ELSE 0.6 END::DOUBLE), 6) AS mean_confidence FROM shown WHERE candidate GROUP BY 1",
    "student_examples": f"WITH {EXAMPLE} SELECT 'sparse:' || custom_id AS example_id, md5(input) AS input_md5, sparse, first, {_split('document_id')} AS split FROM example",
    "training_summary": f"WITH {EXAMPLE}, e AS (SELECT *, {_split('document_id')} AS split FROM example) SELECT g.split, count(e.custom_id) AS n, count(*) FILTER (WHERE e.sparse = 'NO_BOUNDARY') AS n_none, coalesce(sum(e.n_lines), 0)::BIGINT AS n_lines, round(coalesce(avg(len(e.input)), 0), 6)::DOUBLE AS mean_input, round(coalesce(avg(len(e.sparse)), 0), 6)::DOUBLE AS mean_output FROM (VALUES ('train'), ('validation'), ('test')) g(split) LEFT JOIN e USING (split) GROUP BY 1",
    "extracted_sentences": f"WITH {W} SELECT custom_id, sid AS local_sid, text FROM shown WHERE candidate",
    "parse_issues": f"""WITH {EXAMPLE}, o AS (SELECT custom_id AS example_id, {FAULT} AS output, sids FROM example),
l AS (SELECT example_id, sids, unnest(string_split(output, chr(10))) AS line, generate_subscripts(string_split(output, chr(10)), 1) AS k, trim(output) = '' AS blank FROM o WHERE output <> 'NO_BOUNDARY'),
t AS (SELECT *, CASE WHEN len(list_filter(string_split(line, ' '), lambda x: x <> '')) = 2 THEN string_split(line, ' ')[1] END AS token, CASE WHEN len(list_filter(string_split(line, ' '), lambda x: x <> '')) = 2 THEN string_split(line, ' ')[2] END AS label FROM l WHERE blank OR trim(line) <> ''),
n AS (SELECT *, try_cast(regexp_extract(token, '^S([0-9]+)$', 1) AS BIGINT) AS num FROM t),
b AS (SELECT *, last_value(num IGNORE NULLS) OVER (PARTITION BY example_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, row_number() OVER (PARTITION BY example_id, token ORDER BY k) AS nth FROM n),
f AS (SELECT example_id, (token IS NULL OR num IS NULL) AS a, coalesce(NOT list_contains(sids, token), false) AS u, coalesce(label NOT IN ({LABELS}), false) AS c, token IS NOT NULL AND nth > 1 AS d, coalesce(num <= before, false) AS e FROM b)
SELECT example_id, count(*) FILTER (WHERE a) AS invalid_line, count(*) FILTER (WHERE u) AS unknown_local_sid, count(*) FILTER (WHERE c) AS invalid_label, count(*) FILTER (WHERE d) AS duplicate_local_sid, count(*) FILTER (WHERE e) AS not_ascending, count(*) FILTER (WHERE NOT (a OR u OR c OR d)) AS n_boundaries FROM f GROUP BY 1""",
    "boundary_scores": f"""WITH RECURSIVE {GOLD},
fold AS (SELECT custom_id, 1 AS k, gs AS rest, 0 AS tp FROM duo UNION ALL SELECT f.custom_id, k + 1, CASE WHEN c IS NULL THEN rest ELSE list_filter(rest, lambda x: x <> c) END, tp + (c IS NOT NULL)::INT FROM (SELECT f.*, CASE WHEN list_contains(rest, ps[k]) THEN ps[k] WHEN list_contains(rest, ps[k] - 1) THEN ps[k] - 1 WHEN list_contains(rest, ps[k] + 1) THEN ps[k] + 1 END AS c, ps FROM fold f JOIN duo USING (custom_id)) f WHERE k <= len(ps)),
near AS (SELECT custom_id, max(tp) AS near_tp FROM fold GROUP BY 1),
x AS (SELECT custom_id, len(gs) AS g, len(ps) AS p, len(list_intersect(gs, ps)) AS tp, near_tp FROM duo JOIN near USING (custom_id))
SELECT custom_id, tp::BIGINT AS tp, (p - tp)::BIGINT AS fp, (g - tp)::BIGINT AS fn, {_f1('tp', 'g', 'p')} AS f1, near_tp::BIGINT AS near_tp, {_f1('near_tp', 'g', 'p')} AS near_f1 FROM x""",
    "segmentation_scores": f"""WITH {GOLD}, k AS (SELECT *, greatest(1, least(n - 1, round_even(n / (len(list_filter(gs, lambda b: b >= 1 AND b < n)) + 1) / 2, 0)))::BIGINT AS k FROM duo),
i AS (SELECT custom_id, n, k, gs, ps, unnest(range(1, n - k + 1)) AS i FROM k),
c AS (SELECT custom_id, n, k, len(list_filter(gs, lambda b: b >= i AND b < i + k)) AS g, len(list_filter(ps, lambda b: b >= i AND b < i + k)) AS p FROM i)
SELECT custom_id, round(count(*) FILTER (WHERE (g = 0) <> (p = 0)) / count(*), 6)::DOUBLE AS pk, round(count(*) FILTER (WHERE g <> p) / count(*), 6)::DOUBLE AS window_diff FROM c GROUP BY 1""",
    "training_rows": f"WITH {SENTENCES} SELECT sentence_id AS left_sentence_id, lead(sentence_id) OVER (PARTITION BY document_id ORDER BY p) AS right_sentence_id, {_label('text')} <> 'none' AS split_after_left, {_label('text')} AS boundary_type, CASE WHEN p % 4 = 0 THEN 'needs_review' ELSE 'teacher_only' END AS review_status FROM sentence",
    "label_scores": f"""WITH {W}, s AS (SELECT {', '.join(f'({v})::DOUBLE AS s{i}' for i, v in enumerate(SCORE.values()))} FROM shown WHERE candidate),
m AS (SELECT *, greatest({', '.join(f's{i}' for i in range(8))}) AS top FROM s),
p AS (SELECT CASE {' '.join(f"WHEN s{i} = top THEN '{x}'" for i, x in enumerate(BOUNDARY_TYPES))} END AS predicted, round(1 / ({' + '.join(f'exp(s{i} - top)' for i in range(8))}), 6) AS probability FROM m)
SELECT predicted, count(*) AS n, round(sum(probability), 4)::DOUBLE AS mass FROM p GROUP BY 1""",
    "feature_sums": f"""WITH {W}, c AS (SELECT custom_id, num, text FROM shown WHERE candidate), f AS (SELECT 'bias' AS feature FROM c UNION ALL SELECT 'sid_bucket:' || least(num, 20) FROM c UNION ALL SELECT 'len_bucket:' || least(len(text) // 20, 10) FROM c UNION ALL SELECT 'sid:first' FROM c WHERE num = 1 {' '.join(f"UNION ALL SELECT '{k}' FROM c WHERE {v}" for k, v in CUE.items())}),
h AS (SELECT custom_id, num, unnest(string_split(substr(text, 1, 96), '')) AS x FROM c),
p AS (SELECT custom_id, num, unnest(list_transform(range(1, least(len(substr(text, 1, 96)) - 1, 48) + 1), lambda i: substr(text, i, 2))) AS x FROM c),
g AS (SELECT 'char:' || x AS feature, least(count(*), 4) AS v FROM h WHERE x NOT IN ('', ' ') GROUP BY custom_id, num, x UNION ALL SELECT 'bigram:' || x, least(count(*), 3) FROM p WHERE trim(x) <> '' GROUP BY custom_id, num, x UNION ALL SELECT feature, 1 FROM f)
SELECT feature, count(*) AS n, sum(v)::DOUBLE AS total FROM g GROUP BY 1""",
    "browse_sort": f"WITH {EXAMPLE} SELECT 'sparse:' || custom_id AS example_id, n_lines::BIGINT AS n FROM example ORDER BY n_lines DESC, 'sparse:' || custom_id LIMIT 40",
    "label_histogram": f"WITH {EXAMPLE}, l AS (SELECT label FROM shown WHERE candidate AND label <> 'none' UNION ALL SELECT 'NO_BOUNDARY' FROM example WHERE n_lines = 0) SELECT g.label, count(l.label) AS n FROM (SELECT unnest([{LABELS}, 'NO_BOUNDARY']) AS label) g LEFT JOIN l USING (label) GROUP BY 1",
    "sft_split_counts": f"WITH {EXAMPLE}, e AS (SELECT {_split('document_id')} AS split FROM example) SELECT f.target_type, g.split, count(e.split) AS n FROM (VALUES ('sparse_multi_boundary'), ('first_boundary')) f(target_type) CROSS JOIN (VALUES ('train'), ('validation'), ('test')) g(split) LEFT JOIN e ON e.split = g.split GROUP BY 1, 2",
    "sft_examples": f"WITH {EXAMPLE}, e AS (SELECT *, {_split('document_id')} AS split FROM example) SELECT 'sparse:' || custom_id AS example_id, 'sparse_multi_boundary' AS target_type, split, md5(input) AS input_md5, sparse AS output FROM e UNION ALL SELECT 'first:' || custom_id, 'first_boundary', split, md5(input), first FROM e",
    "example_mapping": f"WITH {W}, m AS (SELECT custom_id, count(*) AS n FROM shown GROUP BY 1) SELECT 'sparse:' || custom_id AS example_id, custom_id, n AS n_sources FROM m UNION ALL SELECT 'first:' || custom_id, custom_id, n FROM m",
    "training_scores": f"""WITH RECURSIVE {GOLD},
fold AS (SELECT custom_id, 1 AS k, gs AS rest, 0 AS tp FROM duo UNION ALL SELECT f.custom_id, k + 1, CASE WHEN c IS NULL THEN rest ELSE list_filter(rest, lambda x: x <> c) END, tp + (c IS NOT NULL)::INT FROM (SELECT f.*, CASE WHEN list_contains(rest, ps[k]) THEN ps[k] WHEN list_contains(rest, ps[k] - 1) THEN ps[k] - 1 WHEN list_contains(rest, ps[k] + 1) THEN ps[k] + 1 END AS c, ps FROM fold f JOIN (SELECT custom_id, list_filter(ps, lambda x: x <= n) AS ps FROM duo) USING (custom_id)) f WHERE k <= len(ps)),
near AS (SELECT custom_id, max(tp) AS near_tp FROM fold GROUP BY 1),
d AS (SELECT custom_id, n, gs, list_filter(ps, lambda x: x <= n) AS ps FROM duo),
x AS (SELECT sum(len(gs)) AS g, sum(len(ps)) AS p, sum(len(list_intersect(gs, ps))) AS tp, sum(near_tp) AS ntp, count(*) AS m FROM d JOIN near USING (custom_id)),
i AS (SELECT gs, ps, unnest(range(1, n + 1)) AS i FROM d),
y AS (SELECT count(*) AS n, avg(ln(1 + i % 7)) AS loss, avg((list_contains(gs, i) = list_contains(ps, i))::INT) AS accuracy FROM i)
SELECT y.n AS candidate_count, m AS example_count, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, round(tp / p, 6) AS "precision", round(tp / g, 6) AS recall, round(2 * tp / (p + g), 6) AS f1, round(2 * ntp / (p + g), 6) AS tolerance1_f1 FROM x, y""",
    "doc_validation": f"""WITH {SENTENCES},
i AS (SELECT document_id, p, CASE WHEN p % 23 = 5 THEN 'nowhere' ELSE sentence_id END AS sid, p % 3 = 0 AS split, CASE WHEN p % 19 = 1 THEN 'odd' WHEN p % 4 = 0 THEN 'topic_shift' ELSE 'none' END AS label FROM sentence WHERE p % 29 <> 7),
lost AS (SELECT document_id FROM sentence s WHERE p % 29 = 7 OR p % 23 = 5),
odd AS (SELECT DISTINCT document_id FROM i WHERE sid = 'nowhere'),
r AS (SELECT 'coverage_mismatch' AS code, document_id FROM (SELECT document_id FROM lost UNION SELECT document_id FROM odd) UNION ALL SELECT 'missing_sentence_annotation', document_id FROM lost UNION ALL SELECT 'unknown_sentence_id', document_id FROM odd
  UNION ALL SELECT 'unknown_boundary_type', document_id FROM i WHERE label = 'odd' UNION ALL SELECT 'split_false_boundary_type_not_none', document_id FROM i WHERE NOT split AND label <> 'none' UNION ALL SELECT 'split_true_boundary_type_none', document_id FROM i WHERE split AND label = 'none')
SELECT code, count(*) AS n, count(DISTINCT document_id) AS n_documents FROM r GROUP BY 1""",
    "annotation_summary": f"WITH {W} SELECT label AS boundary_type, count(*) AS n, count(*) FILTER (WHERE label <> 'none') AS n_split FROM shown WHERE candidate GROUP BY 1",
    "label_requests": f"WITH {W} SELECT custom_id, 'POST' AS method, '/v1/responses' AS url, document_id, md5(string_agg('<' || sid || '> ' || text, chr(10) ORDER BY num)) AS anchored_md5, string_agg(CASE WHEN candidate THEN sid END, ',' ORDER BY num) AS target_sids, 'quality_flags' AS third_key, 8192::BIGINT AS max_output_tokens FROM shown GROUP BY custom_id, document_id",
    "browse": f"WITH {EXAMPLE} SELECT custom_id, n_lines::BIGINT AS n_lines FROM example WHERE contains(lower(input), 'chapter 9') AND contains(sparse, 'topic_shift')",
    "gold_vs_predicted": f"WITH {GOLD} SELECT CASE WHEN gold.g IS NULL THEN 'FP' WHEN pred.g IS NULL THEN 'FN' ELSE 'match' END AS status, count(*) AS n FROM gold FULL JOIN pred ON gold.custom_id = pred.custom_id AND gold.g = pred.g GROUP BY 1",
    "routed_results": f"""WITH {W}, c AS (SELECT custom_id, w % 8 AS k, sid, num, label, row_number() OVER (PARTITION BY custom_id ORDER BY num) AS nth FROM shown WHERE candidate),
e AS (SELECT custom_id, k, min(CASE WHEN k = 5 THEN 0.9 WHEN label <> 'none' THEN 0.35 ELSE 0.6 END) AS low, min(CASE WHEN nth = 1 THEN label END) AS first, count(*) AS n FROM c GROUP BY ALL),
r AS (SELECT CASE WHEN k IN (1, 2, 7) THEN 'failure' WHEN k IN (3, 4, 6) THEN 'issues' ELSE 'ok' END AS route, k NOT IN (1, 2, 3, 4, 6, 7) AND low < 0.75 AS needs_review, CASE WHEN k IN (1, 2) THEN 'ValueError' WHEN k = 7 THEN 'MissingBatchResult' ELSE '' END AS exception_type,
  CASE WHEN k = 3 THEN 'unknown_boundary_type' || CASE WHEN first = 'none' THEN ',split_false_boundary_not_none' ELSE '' END WHEN k = 4 THEN 'invalid_confidence' WHEN k = 6 THEN 'missing_target_annotation' ELSE '' END AS codes FROM e
  UNION ALL SELECT 'failure', false, 'ValueError', '' FROM e WHERE k = 0)
SELECT route, needs_review, exception_type, codes, count(*) AS n FROM r GROUP BY ALL""",
    "html_headings": "SELECT source_id, n FROM (SELECT page_id AS source_id, len(list_filter(regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), lambda x: trim(x) <> ''))::BIGINT AS n FROM pages) WHERE n > 0",
}
