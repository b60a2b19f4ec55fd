"""Text functions as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WS = r"(?U)[\s\x1c-\x1f]+"
#: The characters of WS.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Labels in order, noise marks, sentence ends, cues and patterns.
BOUNDARY_TYPES = ["none", "topic_shift", "scripture_reading_start", "scripture_explanation_start", "illustration_start", "application_start", "prayer_or_closing", "enumeration_start"]
STUDENT_LABELS = BOUNDARY_TYPES[1:]
NOISE_MARKS = ["•", "-", "—", "_"]
SENTENCE_END = "[.!?。！？]"
KOREAN_END = "[다요죠까라니함됨음]"
REFERENCE_IN_TEXT = r"\([^)]+[0-9]+[:：][0-9]+"
REFERENCE_LINE = r"^\([^)]*(?:요|마|막|눅|롬|고전|고후|창|출|시|사)[^)]*[0-9][^)]*\)$"
SCRIPTS = {"hangul": "가-힯ᄀ-ᇿ㄰-㆏", "han": "一-鿿", "latin": "A-Za-zÀ-ÖØ-öø-ɏ", "greek": "Ͱ-Ͽ", "hebrew": "֐-׿"}
KINDS = {"기도": "prayer", "논문": "thesis", "공지": "notice"}
# End of fixed values.

LONG = 450
#: How many texts are Python objects at a time.
SLICE = 500
_MARK, _ODD_ASCII = "\x1f", [c for c in SPACES if c not in " \n" and c < "\x80"]
_ODD, _SPACES, _KOREAN = re.compile(f"[{SPACES[10:]}]"), re.compile(f"[{SPACES.replace(chr(10), '')}]+"), re.compile(f"({KOREAN_END}) ")


def let(value: Column, then) -> Column:
    """then(value), with value computed once: an expression that is used twice is otherwise computed twice, in lambdas for every element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with these columns, computed once a row: what a generator makes is not computed again where a later filter is pushed below it."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def normalize_ws(text: Column) -> Column:
    """Runs of white space (Unicode's and U+001C-U+001F) as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, WS, " "))


def is_layout_noise(text: Column) -> Column:
    bare = normalize_ws(text)
    return (bare == "") | bare.rlike("^[0-9]{1,3}$") | bare.isin(NOISE_MARKS)


def script_count(text: Column, script: str) -> Column:
    """How many characters are of a script. A text of as many bytes as characters is ASCII, which has Latin ones only."""
    found = F.length(F.regexp_replace(text, f"[^{SCRIPTS[script]}]+", ""))
    return found if script == "latin" else F.when(F.octet_length(text) == F.length(text), 0).otherwise(found)


def language_reason(text: Column, counts: dict[str, Column] | None = None) -> Column:
    """Why a paragraph is kept or dropped; the first two reasons keep it. counts: the scripts' counts, where they are columns already."""
    n = counts or {s: script_count(text, s) for s in ("hangul", "han", "latin")}
    return (
        F.when(n["hangul"] >= 2, "hangul_present")
        .when(text.rlike(REFERENCE_IN_TEXT), "scripture_reference_or_short_context")
        .when((n["hangul"] == 0) & (n["han"] >= 2), "han_dominant_foreign")
        .when((n["hangul"] == 0) & (n["latin"] >= 20), "latin_dominant_foreign")
        .otherwise("no_korean_signal")
    )


def keeps(reason: Column) -> Column:
    return reason.isin("hangul_present", "scripture_reference_or_short_context")


def is_kept(text: Column) -> Column:
    return keeps(language_reason(text))


def document_kind(name: Column) -> Column:
    """By the first of the marks in a (composed) file name."""
    out = F.lit("sermon")
    for mark, kind in reversed(KINDS.items()):
        out = F.when(name.contains(mark), kind).otherwise(out)
    return out


def split_sentences(text: Column) -> Column:
    """Sentences of a block: after sentence ends; a long block without any, after Korean endings. Pieces under two characters go."""
    korean = F.split(text, f"(?<={KOREAN_END}){WS}", -1)
    parts = let(F.split(text, f"(?<={SENTENCE_END}){WS}", -1), lambda p: F.when((F.size(p) == 1) & (F.length(text) > LONG), korean).otherwise(p))
    return F.filter(F.transform(parts, normalize_ws), lambda x: F.length(x) >= 2)


def split_lines(text: Column) -> Column:
    """Sentences of all lines of a text, as split_sentences finds them in each normalized line. The text is gone through as a whole: spaces at which
    sentences end become marks, which no normalized text holds."""
    return F.arrow_udf(_split_texts, "array<string>")(text)


def _split_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield pa.array([None if t is None else _split_text(t) for t in batch.slice(at, SLICE).to_pylist()], pa.list_(pa.string()))


def _split_text(text: str) -> list[str]:
    if "  " in text or any(c in text for c in _ODD_ASCII) or not text.isascii() and _ODD.search(text):
        text = _SPACES.sub(" ", text)
    text = text.replace(" \n", "\n").replace("\n ", "\n").strip(" ")
    for end in SENTENCE_END[1:-1]:
        text = text.replace(f"{end} ", end + _MARK)
    if len(text) > LONG:
        text = _MARK.join([_KOREAN.sub(rf"\1{_MARK}", x) if len(x) > LONG and _MARK not in x else x for x in text.split("\n")])
    return [x for x in text.replace("\n", _MARK).split(_MARK) if len(x) >= 2]


def boundary_label(text: Column) -> Column:
    """A label by rules, in order."""
    return let(F.btrim(text, F.lit(SPACES)), _label)


def _label(bare: Column) -> Column:
    return (
        F.when(bare == "", "none")
        .when((bare == "기도하겠습니다.") | bare.isin("아멘.", "아멘") | bare.endswith("기도합니다."), "prayer_or_closing")
        .when(bare.startswith("Chapter ") | bare.startswith("제"), "topic_shift")
        .when((bare.startswith("(") & bare.rlike(REFERENCE_LINE)) | bare.contains("다음과 같이 표현합니다"), "scripture_reading_start")
        .otherwise("none")
    )


def padded(number: Column) -> Column:
    """A number that isn't negative as %04d writes it."""
    return F.when(number < 10_000, F.substring((number + 10_000).cast("string"), 2, 4)).otherwise(number.cast("string"))


def sid_number(sid: Column) -> Column:
    """S<digits> as a number, else null."""
    return F.regexp_extract(sid, "^S([0-9]+)$", 1).try_cast("int")


def document_id(source_type: str, path: Column) -> Column:
    return F.concat(F.lit(f"{source_type}."), F.substring(F.sha1(path), 1, 12))


def split_name(doc: Column) -> Column:
    """train, validation or test by sha1(id) mod 10. As 16**k is 6 mod 10, that is the last digit plus 6 times the others' sum."""
    digits = F.transform(F.split(F.sha1(doc), ""), lambda d: F.conv(d, 16, 10).cast("int"))
    digits = F.filter(digits, lambda d: d.isNotNull())
    bucket = F.aggregate(F.slice(digits, 1, 39), F.lit(0), lambda s, d: s + 6 * d, lambda s: s) + F.element_at(digits, 40)
    bucket = F.pmod(bucket, F.lit(10))
    return F.when(bucket < 8, "train").when(bucket == 8, "validation").otherwise("test")
