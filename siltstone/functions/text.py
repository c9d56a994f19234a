"""Text analysis: tokens, stop words, word pairs, analysers.

All are built-in expressions. The analyser of texts also has a short Arrow UDF for the texts that need no class by
property: the search for tokens is the largest part of its time, and several times faster there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The default English stop set of the public Lucene library.
ENGLISH_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of",
    "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
]

# The Vietnamese stop words. Entries with a blank can never equal a single token.
VIETNAMESE_STOP_WORDS = [
    "bị", "bởi", "cả", "các", "cái", "cần", "càng", "chỉ", "chiếc", "cho", "chứ", "chưa", "chuyện", "có", "có thể",
    "cứ", "của", "cùng", "cũng", "đã", "đang", "đây", "để", "đến nỗi", "đều", "điều", "do", "đó", "được", "dưới", "gì",
    "khi", "không", "là", "lại", "lên", "lúc", "mà", "mỗi", "một cách", "này", "nên", "nếu", "ngay", "nhiều", "như",
    "nhưng", "những", "nơi", "nữa", "phải", "qua", "ra", "rằng", "rằng", "rất", "rất", "rồi", "sau", "sẽ", "so", "sự",
    "tại", "theo", "thì", "trên", "trong", "trước", "từ", "từng", "và", "vẫn", "vào", "vậy", "vì", "việc", "với",
    "vừa",
]

# Fixed value: a whole term that is a plain decimal number.
NUMBER_PATTERN = "^(0|[1-9][0-9]*)$"

# The pictographs of the public Unicode table (property Extended_Pictographic), as hexadecimal ranges.
PICTOGRAPHS = """
    A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0
    25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642
    2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB
    26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705
    2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797
    27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F02C-1F02F 1F094-1F09F
    1F0AF-1F0B0 1F0C0 1F0CF-1F0D0 1F0F6-1F0FF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F1AF-1F1E5 1F201-1F20F
    1F21A 1F22F 1F232-1F23A 1F23C-1F23F 1F249-1F25F 1F266-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0
    1F3F3-1F3F5 1F3F7-1F3FA 1F400-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587
    1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1
    1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6E5 1F6E9 1F6EB-1F6F0 1F6F3-1F6FF
    1F7DC-1F7F0 1F80C-1F80F 1F848-1F84F 1F85A-1F85F 1F888-1F88F 1F8AE-1F8AF 1F8BC-1F8BF 1F8C2-1F8CF 1F8D9-1F8FF
    1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA58-1FA5F 1FA6E-1FAFF 1FC00-1FFFD
"""


_BEYOND = r"(?=[^\x00-\x7F])"


def _class(ascii_part: str, rest: str) -> str:
    """The inside of a class that turns most ASCII characters away after one comparison."""
    return rf"{ascii_part}[[^\x00-\x7F]&&[{rest}]]"


# The classes of the public word-break rules (UAX #29), by properties; what the properties miss is written out.
# Marks and format characters belong to the character before them.
_EXTEND = _class("", r"\p{M}\p{Cf}\uFF9E\uFF9F\x{1F3FB}-\x{1F3FF}&&[^\u200B\u0600-\u0605\u06DD\u070F\u0890\u0891\u08E2\x{110BD}\x{110CD}]")
_KATAKANA = _class("", r"\p{IsKatakana}\u3031-\u3035\u309B\u309C\u30A0\u30FC\uFF70")
# Scripts without blanks between words, whose runs are one token.
_UNSPACED = r"\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}\p{IsTai_Viet}\p{IsAhom}"
_HEBREW = r"[\p{IsHebrew}&&\p{L}]"
# Latin ranges come first, as they are cheap to test.
_LATIN = r"a-zA-Z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02C1\u1E00-\u1EFF"
_LETTER = _class(_LATIN, (
    rf"[\p{{IsAlphabetic}}&&[^\p{{IsIdeographic}}\p{{IsHiragana}}\p{{M}}\uFF9E\uFF9F{_KATAKANA}{_UNSPACED}]]"
    r"\u00B8\u02C2-\u02C5\u02D2-\u02D7\u02DE\u02DF\u02E5-\u02EB\u02ED\u02EF-\u02FF\u055A-\u055C\u055E\u058A\u05F3\u070F"
    r"\uA708-\uA716\uA720\uA721\uA789\uA78A\uAB5B"
))
_DIGIT = _class("0-9", r"\p{Nd}\u0600-\u0605\u066B\u06DD\u0890\u0891\u08E2\u19DA\x{110BD}\x{110CD}")
_JOIN_BOTH = r"\u2018\u2019\u2024\uFE52\uFF07\uFF0E"
_JOIN_LETTERS = _class(".':", rf"\u00B7\u0387\u055F\u05F4\u2027\uFE13\uFE55\uFF1A{_JOIN_BOTH}")
_JOIN_DIGITS = _class(".',;", rf"\u037E\u0589\u060C\u060D\u066C\u07F8\u2044\uFE50\uFE54\uFF0C\uFF1B{_JOIN_BOTH}")
_LINK = _class("_", r"\p{Pc}\u202F")


def _run(fast: str, first: str) -> str:
    """A run of characters of a class, with the marks on them; ``fast`` is the part of the class that is cheap to test."""
    slow = rf"[{first}{_EXTEND}]"
    head = rf"[{fast}]++(?:{_BEYOND}{slow}++)?+|" if fast else ""
    return rf"(?:{head}{_BEYOND}[{first}]{slow}*+)"


def _ranges(table: str) -> str:
    return "".join("-".join(rf"\x{{{end}}}" for end in entry.split("-")) for entry in table.split())


# A token is a run of letter groups, digit groups, Katakana runs and underscores with at least one that is no
# underscore; only an underscore joins Katakana to others. Ideographs and Hiragana stand alone, so do pictographs with
# what is joined to them and pairs of regional indicators; a few signs are pictographs only if the selector says so.
# Every quantifier is possessive, so long runs need neither backtracking nor stack depth.
_X = rf"[{_EXTEND}]*+"
_AFTER_HEBREW = rf"(?<={_HEBREW}[{_EXTEND}]{{0,4}}['\x22])"
_INSIDE = rf"(?:[{_JOIN_LETTERS}]{_X}|\x22{_AFTER_HEBREW}{_X}(?={_HEBREW}))"
_LETTERS = rf"{_run(_LATIN, _LETTER)}(?:{_INSIDE}{_run(_LATIN, _LETTER)})*+"
_DIGITS = rf"{_run("0-9", _DIGIT)}(?:[{_JOIN_DIGITS}]{_X}{_run("0-9", _DIGIT)})*+"
_GROUP = rf"(?:(?:{_LETTERS}|{_DIGITS})++|{_run("", _KATAKANA)})"
_LINKS = _run("_", _LINK)
_WORD = rf"(?:(?=[{_LINK}])(?<![{_LINK}]){_LINKS})?+{_GROUP}(?:{_LINKS}{_GROUP})*+(?:{_LINKS})?+(?:'{_AFTER_HEBREW}{_X})?+"
_ALONE = rf"[\p{{IsIdeographic}}\p{{IsHan}}\p{{IsHiragana}}&&[\p{{L}}\p{{N}}\p{{So}}]]{_X}"
_PICTOGRAPH = rf"(?![\u00A9\u00AE\u2122\u3030\u303D](?!\uFE0F))[{_ranges(PICTOGRAPHS)}](?!\uFE0E){_X}"
_EMOJI = rf"{_PICTOGRAPH}(?:(?<=\u200D){_PICTOGRAPH})*+|(?:[\x{{1F1E6}}-\x{{1F1FF}}]{_X}){{2}}"
_UNSPACED_RUN = _run("", rf"[[{_UNSPACED}]&&[\p{{L}}\p{{M}}]]")
TOKEN_PATTERN = rf"{_WORD}|[#*]\uFE0F?+\u20E3|{_BEYOND}(?:{_ALONE}|{_UNSPACED_RUN}|{_EMOJI})"

# The same tokens for texts of ASCII, Latin letters and common punctuation, which need no class by property.
_PLAIN_TEXT = r"\x00-\x7F\u00A0\u00A7\u00AB\u00B0\u00BB-\u00BF\u00C0-\u02C1\u1E00-\u1EFF\u2010-\u2023\u2025\u2026\u20AC"
_PLAIN_GROUP = rf"[{_LATIN}]++(?:[.':\u2018\u2019][{_LATIN}]++)*+|[0-9]++(?:[.',;\u2018\u2019][0-9]++)*+"
PLAIN_PATTERN = rf"(?<!_)_*+(?:{_PLAIN_GROUP})(?:{_PLAIN_GROUP}|_)*+"

#: Longer tokens are cut into pieces of so many characters, each of which is read anew.
TOKEN_LENGTH = 255


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# The lambdas below are SQL text: one parse instead of a call into the JVM per literal and operator.
_PAIRS = """
    zip_with(slice(w, 1, greatest(size(w) - 1, 0)), slice(w, 2, greatest(size(w) - 1, 0)),
             (a, b) -> coalesce(a || ' ' || b, a, b))"""

# Comparing with ":", the character after "9", spares most terms the pattern match.
_BLANK_NUMBER = "IF({0} < ':' AND {0} RLIKE '" + NUMBER_PATTERN + "', '', {0})"

_TERMS = f"array_compact(flatten(zip_with(w, {_PAIRS}, (a, b) -> array({_BLANK_NUMBER.format('a')}, b))))"


def bind(value: Column, body: str) -> Column:
    """The SQL ``body`` over ``w``, with ``w`` = ``value`` evaluated once per row."""
    return F.element_at(F.call_function("transform", F.array(value), F.expr(f"w -> {body}")), 1)


_PIECES = f"""
    flatten(transform(sequence(0, CAST((char_length(t) - 1) DIV {TOKEN_LENGTH} AS INT)),
        i -> regexp_extract_all(substring(t, i * {TOKEN_LENGTH} + 1, {TOKEN_LENGTH}), r"{TOKEN_PATTERN}", 0)))"""

# One possessive run over the text is many times faster than a search for a character outside the class.
_TOKENS = rf"""
    IF(w RLIKE r"\A[{_PLAIN_TEXT}]*+\z", regexp_extract_all(w, r"{PLAIN_PATTERN}", 0), regexp_extract_all(w, r"{TOKEN_PATTERN}", 0))"""

# The number of bytes is at hand for every token, that of characters has to be counted.
_CUT = f"""
    IF(exists(w, t -> octet_length(t) > {TOKEN_LENGTH}),
       flatten(transform(w, t -> IF(octet_length(t) > {TOKEN_LENGTH} AND char_length(t) > {TOKEN_LENGTH}, {_PIECES}, array(t)))), w)"""


def tokenize(text: Column | str) -> Column:
    """Lower-case tokens in order, by the public word-break rules; NULL for NULL.

    A token of more than ``TOKEN_LENGTH`` characters gives the tokens of its pieces.
    """
    return bind(bind(F.lower(_column(text)), _TOKENS), _CUT)


def blank_stop_words(tokens: Column | str, words: list[str]) -> Column:
    """Replace stop words by NULL so that the positions of the other tokens are kept."""
    listed = ", ".join("'" + word.replace("'", "\\'") + "'" for word in words)
    return F.call_function("transform", _column(tokens), F.expr(f"t -> IF(t IN ({listed}), NULL, t)"))


def word_pairs(slots: Column | str) -> Column:
    """Pairs of neighbouring words, one entry per adjacent pair of slots.

    NULL slots are gaps: next to a gap the entry is the other word alone, between two gaps it
    is NULL. The result is one shorter than the input.
    """
    return bind(_column(slots), _PAIRS)


def blank_number(term: str) -> Column:
    """The empty term for a plain decimal number, any other term of the column unchanged."""
    return F.expr(_BLANK_NUMBER.format(term))


#: Texts of more bytes stay with the built-in expressions; rows that are analysed together, and that go to Python together.
UDF_BYTES, UDF_ROWS, BATCH_ROWS = 1 << 20, 50, 500
#: Characters and texts that a task counts in Python together, at most; the product of words, words and texts is a long.
PART_CHARS, PART_TEXTS = 8_000_000, 10_000

_STOP_WORDS = ENGLISH_STOP_WORDS + VIETNAMESE_STOP_WORDS
_OUTER_MARKS = ".,;:'\"!?()[]{}<>/*#-\u2013\u2014\u2018\u2019\u201c\u201d\u2026\u00ab\u00bb"
_ARROW_TERMS = pa.list_(pa.string())


def _bound_batches(spark: SparkSession) -> None:
    """At most ``BATCH_ROWS`` rows go to Python together from then on."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _patterns() -> tuple[frozenset, re.Pattern, re.Pattern, re.Pattern]:
    """Stop words and the patterns of plain texts, tokens and numbers."""
    return frozenset(_STOP_WORDS), re.compile(rf"[{_PLAIN_TEXT}]*+"), re.compile(PLAIN_PATTERN), re.compile(NUMBER_PATTERN)


def _cut(words: list[str], token: re.Pattern) -> list[str]:
    """Tokens with the long ones cut."""
    if not words or max(map(len, words)) <= TOKEN_LENGTH:
        return words
    pieces = [[w] if len(w) <= TOKEN_LENGTH else [w[at:at + TOKEN_LENGTH] for at in range(0, len(w), TOKEN_LENGTH)] for w in words]
    return [x for parts in pieces for part in parts for x in (token.findall(part) if len(parts) > 1 else parts)]


def _plain_terms(text: str | None, stop_words: frozenset, plain: re.Pattern, token: re.Pattern, number: re.Pattern) -> list[str] | None:
    """The terms of a lower-case text without classes by property, None for any other: the same as ``_TERMS`` gives."""
    if text is None or not plain.fullmatch(text):
        return None
    words = [None if w in stop_words else w for w in _cut(token.findall(text), token)]
    out = []
    for a, b in zip(words, words[1:]):
        if a is not None:
            out.append("" if a < ":" and number.fullmatch(a) else a)
            out.append(a if b is None else f"{a} {b}")
        elif b is not None:
            out.append(b)
    if words and words[-1] is not None:
        out.append("" if number.fullmatch(words[-1]) else words[-1])
    return out


def _plain_counts(texts: list[str], token: re.Pattern) -> tuple[pa.Array, np.ndarray]:
    """The terms of lower-case texts without classes by property, and in how many of these texts each is.

    Blanks lie in no token and other marks at neither end of one, so a text is cut at its blanks and every distinct
    piece is read once. Terms are counted as numbers: of a word, of the empty term, or of a pair of words.
    """
    cut = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
    pieces = cut.flatten().dictionary_encode()
    words, ends = [], [0]
    for piece in pieces.dictionary.to_numpy(zero_copy_only=False):
        bare = piece.strip(_OUTER_MARKS)
        words += [bare] if bare.isalpha() and len(bare) <= TOKEN_LENGTH else _cut(token.findall(bare), token)
        ends.append(len(words))
    if not words:
        return pa.array([], pa.string()), np.empty(0, np.int64)
    coded = pa.array(words, pa.string()).dictionary_encode()
    names, size = coded.dictionary, len(coded.dictionary)
    is_stop = pc.is_in(names, pa.array(_STOP_WORDS)).to_numpy(zero_copy_only=False)
    is_number = pc.match_substring_regex(names, NUMBER_PATTERN).to_numpy(zero_copy_only=False)

    # All tokens of the texts in their order, and their texts.
    piece, ends = pieces.indices.to_numpy(), np.array(ends)
    n = np.diff(ends)[piece]
    token_at = np.repeat(ends[piece] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    word = coded.indices.to_numpy().astype(np.int64)[token_at]
    text = np.repeat(np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy()), n)

    kept, numeral, near = ~is_stop[word], is_number[word], text[1:] == text[:-1]
    both = near & kept[1:] & kept[:-1]
    # A number is blanked, and also stays as itself beside a gap.
    before_gap, after_gap = near & numeral[:-1] & ~kept[1:], near & numeral[1:] & ~kept[:-1]
    term = np.concatenate([
        np.where(numeral, size, word)[kept], word[:-1][before_gap], word[1:][after_gap],
        size + 1 + word[:-1][both] * size + word[1:][both],
    ])
    text = np.concatenate([text[kept], text[:-1][before_gap], text[1:][after_gap], text[:-1][both]])
    # Sorted by term and text: a term in a text is one number, and its repeats are neighbours.
    places = np.sort(term * len(texts) + text)
    found = places[np.concatenate([[True], places[1:] != places[:-1]])[:len(places)]] // len(texts)
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])[:len(found)])
    terms, counts = found[starts], np.diff(np.append(starts, len(found)))
    one, two = terms[terms <= size], terms[terms > size] - size - 1
    return pa.concat_arrays([
        pa.concat_arrays([names, pa.array([""])]).take(pa.array(one)),
        pc.binary_join_element_wise(names.take(pa.array(two // size)), names.take(pa.array(two % size)), " "),
    ]), counts


def _fast_terms(lowered: Column, distinct: bool) -> Column:
    """Terms of plain texts, NULL for others."""
    _bound_batches(SparkSession.active())

    @F.arrow_udf("array<string>")
    def terms(texts: pa.Array) -> pa.Array:
        how, parts = _patterns(), []
        for at in range(0, len(texts), UDF_ROWS):
            rows = [_plain_terms(text, *how) for text in texts.slice(at, UDF_ROWS).to_pylist()]
            if distinct:
                rows = [row and list(dict.fromkeys(row)) for row in rows]
            parts.append(pa.array(rows, _ARROW_TERMS))
        return pa.concat_arrays(parts) if parts else pa.array([], _ARROW_TERMS)

    return terms(lowered)


def analyze(text: Column | str, distinct: bool = False) -> Column:
    """All terms of a text in position order, duplicates kept unless they shall be ``distinct``.

    Tokens, both stop lists, words plus pairs of neighbours, numbers blanked, trimmed. A number
    next to a gap also survives as itself, because the pair it forms with the gap is trimmed
    only after numbers were blanked.
    """
    built_in = _built_in_terms(text)
    return F.coalesce(_fast_terms(_short_lowered(text), distinct), F.array_distinct(built_in) if distinct else built_in)


def _short_lowered(text: Column | str) -> Column:
    # Lower case comes first: it replaces bytes that are no UTF-8, which Python could not read.
    return F.when(F.octet_length(_column(text)) <= UDF_BYTES, F.lower(_column(text)))


def _built_in_terms(text: Column | str) -> Column:
    return bind(blank_stop_words(tokenize(text), _STOP_WORDS), _TERMS)


def term_parts(df: DataFrame, text: Column | str) -> DataFrame:
    """Rows (term, n) whose sums over n are the numbers of rows with the term among those of :func:`analyze`.

    A task counts plain texts as it reads them, some ``PART_CHARS`` characters together, so neither term arrays nor a row
    per text and term are sent to the JVM. All other texts are taken from a second scan and analysed by the built-in
    expressions; they give a row for each of their distinct terms. A NULL text has no terms.
    """
    _bound_batches(df.sparkSession)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, plain, token, _ = _patterns()
        held, chars = [], 0

        def counted() -> pa.RecordBatch:
            terms, n = _plain_counts(held, token)
            return pa.record_batch([terms, pa.array(n, pa.int64())], names=["term", "n"])

        for batch in batches:
            for lowered in batch[0]:
                lowered = lowered.as_py()
                if lowered is not None and plain.fullmatch(lowered):
                    held.append(lowered)
                    chars += len(lowered)
                    if chars >= PART_CHARS or len(held) == PART_TEXTS:
                        yield counted()
                        held, chars = [], 0
        if held:
            yield counted()

    lowered = _short_lowered(text)
    plain = df.select(lowered.alias("lowered")).where(F.col("lowered").isNotNull()).mapInArrow(parts, "term string, n bigint")
    others = df.where(~F.coalesce(lowered.rlike(rf"\A[{_PLAIN_TEXT}]*+\z"), F.lit(False)))
    return plain.unionByName(others.select(F.explode(F.array_distinct(_built_in_terms(text))).alias("term"), F.lit(1).cast("long").alias("n")))


def analyze_tags(tags: Column | str) -> Column:
    """Tokens of all elements of a tag array: no stop words, no pairs."""
    return F.flatten(F.transform(_column(tags), tokenize))


def word_count(term: Column | str) -> Column:
    """Number of pieces between single blanks, empty pieces counted."""
    return F.size(F.split(_column(term), " ", -1))


def right_strip(line: Column | str) -> Column:
    """The line without trailing white space, Unicode spaces and separators included."""
    return F.regexp_replace(_column(line), r"(?U)[\s\x1C-\x1F]+\z", "")
