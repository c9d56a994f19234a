import functools
import random

import pytest
import regex
from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.operators.search import analyze_text

STOP = set(text.ENGLISH_STOP_WORDS) | set(text.VIETNAMESE_STOP_WORDS)


def values(spark, rows, column):
    df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "i int, t string")
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def model_terms(tokens):
    """Plain model of the analyser on a token list: words and pairs over gaps, in stream order."""
    terms = []
    for i, token in enumerate(tokens):
        word = None if token in STOP else token
        if word is not None:
            terms.append("" if word == "0" or (word.isascii() and word.isdigit() and word[0] != "0") else word)
        if i + 1 < len(tokens):
            following = None if tokens[i + 1] in STOP else tokens[i + 1]
            if word is not None and following is not None:
                terms.append(f"{word} {following}")
            elif word is not None or following is not None:
                terms.append(word if following is None else following)
    return terms


@pytest.mark.parametrize("source, tokens", [
    ("node.js asp.net 1,000.5 front-end can't k8s a:b x_y", "node.js asp.net 1,000.5 front end can't k8s a:b x_y"),
    ("Welcome to Việt Nam … C# .NET", "welcome to việt nam c net"),
    ("__ _a a_ ___", "_a a_"),
    ("日本語 カタカナ ひ 한국어", "日 本 語 カタカナ ひ 한국어"),
    ("3D ab12cd 1.5.6, v1.2", "3d ab12cd 1.5.6 v1.2"),
    ("", ""),
    (" .,;:'’ ", ""),
])
def test_tokenize(spark, source, tokens):
    assert values(spark, [source], text.tokenize("t"))[0] == tokens.split()


def test_tokenize_long_run_and_null(spark):
    long_run = "a1" * 200_000
    pieces = [long_run[i:i + 255] for i in range(0, len(long_run), 255)]
    assert values(spark, [long_run, None, "_" * 200_000], text.tokenize("t")) == [pieces, None, []]


def test_tokenize_cuts_long_tokens(spark):
    rows = ["b " + "ư" * 255, "ư" * 256 + " b", "a" * 254 + ".b", "1" * 254 + "," + "2" * 300, "日" * 300, "_" * 300 + "a"]
    assert values(spark, rows, text.tokenize("t")) == [
        ["b", "ư" * 255], ["ư" * 255, "ư", "b"], ["a" * 254, "b"], ["1" * 254, "2" * 255, "2" * 45], ["日"] * 300, ["_" * 45 + "a"],
    ]


@functools.cache
def word_class(c):
    """The public word-break class of a character, with the scripts that stand apart named."""
    names = ["Extend", "Format", "ZWJ", "Hebrew_Letter", "ALetter", "Numeric", "Katakana", "ExtendNumLet", "MidLetter", "MidNumLet", "MidNum",
             "Single_Quote", "Double_Quote", "Regional_Indicator"]
    for name in names:
        if regex.match(rf"\p{{WB={name}}}", c):
            return name
    for name, pattern in [("Alone", r"(?V1)[[\p{Ideographic}\p{Han}\p{Hiragana}]&&[\p{L}\p{N}\p{So}]]"), ("Unspaced", r"(?V1)[\p{LB=SA}&&[\p{L}\p{M}]]"),
                          ("Pictograph", r"\p{Extended_Pictographic}")]:
        if regex.match(pattern, c):
            return name
    return "Other"


def model_tokens(source):
    """The published rules, boundary by boundary, and the segments that count as tokens."""
    groups = []
    for c in source:
        kind = word_class(c)
        after_joiner = groups and groups[-1][1][-1] == "\u200d" and groups[-1][0] == "Pictograph" and kind == "Pictograph"
        if groups and (kind in ("Extend", "Format", "ZWJ") or after_joiner):
            groups[-1][1] += c
        else:
            groups.append([kind, c])
    kinds = ["H" if k == "Hebrew_Letter" else "L" if k == "ALetter" else k for k, _ in groups]
    at = lambda i: kinds[i] if 0 <= i < len(kinds) else ""
    letter, both = ("L", "H"), ("MidNumLet", "Single_Quote")
    flags, segments = 0, []
    for i, (kind, part) in enumerate(groups):
        a, b = at(i - 1), at(i)
        flags = flags + 1 if a == "Regional_Indicator" else 0
        joined = (
            a in letter and b in letter
            or a in letter and b in ("MidLetter", *both) and at(i + 1) in letter
            or at(i - 2) in letter and a in ("MidLetter", *both) and b in letter
            or a == "H" and b == "Single_Quote"
            or a == "H" and b == "Double_Quote" and at(i + 1) == "H"
            or at(i - 2) == "H" and a == "Double_Quote" and b == "H"
            or a in ("Numeric", *letter) and b in ("Numeric", *letter)
            or at(i - 2) == "Numeric" and a in ("MidNum", *both) and b == "Numeric"
            or a == "Numeric" and b in ("MidNum", *both) and at(i + 1) == "Numeric"
            or a == b == "Katakana"
            or a in ("Numeric", "Katakana", "ExtendNumLet", *letter) and b == "ExtendNumLet"
            or a == "ExtendNumLet" and b in ("Numeric", "Katakana", *letter)
            or a == b == "Regional_Indicator" and flags % 2 == 1
            or a == b == "Unspaced"
        )
        if joined:
            segments[-1][0].append(b)
            segments[-1][1] += part
        else:
            segments.append([[b], part])
    out = []
    for kinds_, part in segments:
        word = {"L", "H", "Numeric", "Katakana", "Alone", "Unspaced"} & set(kinds_) or kinds_ == ["Regional_Indicator"] * 2
        picture = kinds_ == ["Pictograph"] and part[1:2] != "\ufe0e" and (part[0] not in "©®™〰〽" or part[1:2] == "\ufe0f")
        if word or picture:
            out.append(part)
    return out


@pytest.mark.parametrize("source, tokens", [
    ("カタカナabc カタ_カナ カタ1 ｶﾞｷﾞ", ["カタカナ", "abc", "カタ_カナ", "カタ", "1", "ｶﾞｷﾞ"]),
    ("hi😀👍🏽 👩‍👩‍👧 🇻🇳🇯🇵🇫 ❤️ ❤︎", ["hi", "😀", "👍🏽", "👩‍👩‍👧", "🇻🇳", "🇯🇵", "❤️"]),
    ("© ™ ©️ #️⃣ 1️⃣ 🏴\U000e0067\U000e0062\U000e007f", ["©️", "#️⃣", "1️⃣", "🏴\U000e0067\U000e0062\U000e007f"]),
    ("สวัสดีabc", ["สวัสดี", "abc"]),
    ('צה"ל ג\' a" b\'', ['צה"ל', "ג'", "a", "b"]),
    ("x² ½ Ⅳ ⓐ", ["x", "ⅳ", "ⓐ"]),
    ("a\u00adb a\u200bb l·l 1٫5 a.1 1:2", ["a\u00adb", "a", "b", "l·l", "1٫5", "a", "1", "1", "2"]),
])
def test_tokenize_word_breaks(spark, source, tokens):
    assert values(spark, [source], text.tokenize("t"))[0] == tokens
    assert model_tokens(source.lower()) == tokens or "#" in source


def test_tokenize_equals_published_rules(spark):
    rng = random.Random(11)
    pool = [*"aáb1٣_‿.'’,:;·\" -", "é", "\u0301", "\u00ad", "\u200d", "\ufe0f", "א", "ב", "カ", "ー", "ﾞ", "ｶ", "ひ", "日", "々", "ก", "ខ", "한", "😀", "👧",
            "❤", "🇻", "🇯", "🏽", "\u200b", "𝒳", "①", "٫", "״", "\u2060", "٬", "：", "．"]
    rows = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    # The published rules also make a segment of a mark that starts a text; it is no token.
    rows = [row for row in rows if not regex.match(r"[\p{WB=Extend}\p{WB=Format}\p{WB=ZWJ}]", row)]
    plain = [*"aáb1_.'’,:;·\" -", "é", "ß", "ư", "ế", "…", "–", "×", "½", "2", "z", "ʼ", "‘"]
    rows += ["".join(rng.choice(plain) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    for row, got in zip(rows, values(spark, rows, text.tokenize("t"))):
        assert got == model_tokens(row.lower()), [hex(ord(c)) for c in row]


def test_classes_equal_the_public_table(spark):
    known = "".join(chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000)
    ours = {"letter": text._LETTER, "digit": text._DIGIT, "katakana": text._KATAKANA, "extend": text._EXTEND, "link": text._LINK, "pictograph": text._ranges(text.PICTOGRAPHS)}
    theirs = {
        "letter": r"\p{WB=ALetter}\p{WB=Hebrew_Letter}", "digit": r"\p{WB=Numeric}", "katakana": r"\p{WB=Katakana}",
        "extend": r"\p{WB=Extend}\p{WB=Format}\p{WB=ZWJ}", "link": r"\p{WB=ExtendNumLet}", "pictograph": r"\p{Extended_Pictographic}",
    }
    found = lambda pattern: F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
    row = spark.createDataFrame([(known,)], "t string").select(found(r"\P{Cn}").alias("assigned"), *[found(f"[{p}]").alias(n) for n, p in ours.items()]).first()
    assigned = set(row.assigned)
    for name, pattern in theirs.items():
        assert set(row[name]) & assigned == set(regex.findall(f"[{pattern}]", known)) & assigned, name


def test_plain_texts_are_analysed_by_the_udf_as_by_the_built_in_expressions(spark):
    rng = random.Random(12)
    plain = ["a", "b", "Über", "1", "23", "0", "007", "_", "__", ".", ",", ";", ":", "'", "’", "-", " ", "\n", "the", "không", "x" * 300, "9" * 300, "a." * 200, "€"]
    rows = ["".join(rng.choices(plain, k=rng.randint(0, 30))) for _ in range(400)] + ["", "the", "7", "x y " * 5, "ab " * 400_000]
    others = [None, "漢字 a 7 b", "ไทย the", "a 😀 b"]
    df = spark.createDataFrame([(row,) for row in rows + others], "t string")
    built_in = text.bind(text.blank_stop_words(text.tokenize("t"), text.ENGLISH_STOP_WORDS + text.VIETNAMESE_STOP_WORDS), text._TERMS)
    got = df.select(built_in, text.analyze("t"), text.analyze("t", distinct=True), text._fast_terms(F.lower("t"), False)).collect()
    for row, (want, terms, distinct, fast) in zip(rows + others, got):
        assert terms == want and distinct == (want if want is None else list(dict.fromkeys(want)))
        assert fast == (None if row in others else want)


def test_bytes_that_are_no_text_are_analysed_as_before(spark):
    df = spark.range(1).select(F.unhex(F.lit("C3A9FF41FE20616263")).cast("string").alias("t"))
    built_in = text.bind(text.blank_stop_words(text.tokenize("t"), text.ENGLISH_STOP_WORDS + text.VIETNAMESE_STOP_WORDS), text._TERMS)
    first, second = df.select(built_in, text.analyze("t")).collect()[0]
    assert first == second and first


def test_parts_sum_up_to_the_rows_of_every_term(spark, monkeypatch):
    monkeypatch.setattr(text, "PART_CHARS", 400)
    rng = random.Random(13)
    plain = ["a", "b", "Über", "1", "23", "0", "007", "_", "__", ".", ",", ";", ":", "'", "’", "-", "(", "×", " ", "\n", "\x1c", " ", "the", "không", "x" * 300, "9" * 300, "a." * 200, "€"]
    rows = ["".join(rng.choices(plain, k=rng.randint(0, 30))) for _ in range(400)] + ["", "the", "7", "7 the 7", "ab " * 400_000, None, "漢字 a 7 b", "ไทย the", "b 😀"]
    df = spark.createDataFrame([(row,) for row in rows], "t string")
    want = dict(df.select(F.explode(text.analyze("t", distinct=True)).alias("term")).groupBy("term").count().collect())
    assert dict(text.term_parts(df, "t").groupBy("term").agg(F.sum("n")).collect()) == want


def test_parts_of_a_task_have_a_term_once(spark):
    df = spark.range(300).select(F.lit("some words some 12 words").alias("t")).coalesce(1)
    terms = ["", "12 words", "some", "some 12", "some words", "words", "words some"]
    assert sorted(text.term_parts(df, "t").collect()) == [(term, 300) for term in terms]
