"""Text expressions: cleaning, sentences, titles, boilerplate, naming rules. All JVM-side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BOILERPLATE = ["광고", "구독", "앱에서 보기", "관련기사", "관련 기사", "많이 본 뉴스", "인기뉴스", "제보", "무단전재", "재배포 금지", "저작권자", "copyright", "all rights reserved", "페이스북", "카카오톡", "url 복사", "공유하기", "댓글", "뉴스레터", "알림 받기", "기자 페이지"]
STRONG_BOILERPLATE = ["무단전재", "재배포 금지", "copyright", "all rights reserved", "url 복사", "앱에서 보기"]
RELATED = ["관련기사", "관련 기사"]
SHARE = ["공유하기", "페이스북", "카카오톡", "URL 복사", "url 복사"]
FOOTER = r"(?i)제보는|◎공감언론|저작권자\s*[(<ⓒ©]|재배포\s*금지|기자\s*페이지|기사\s*문의|당신이 담은 순간|GoodNews|copyright\s*[(©ⓒ]|all\s+rights\s+reserved|[ⓒ©]\s*\S{0,12}(?:뉴스|일보|신문|닷컴|미디어|방송|경제|데일리|타임스)"
TIME_TITLE = r"(?U)(?:첫째|둘째|셋째|넷째|다섯째|여섯째|일곱째|여덟째|아홉째|열째)\s*(?:날|일)|\d+\s*(?:일차|일째|주차|차)\b"
ATTRIBUTE_TITLE = r"(?U)(?:^|\s)(?:찬성|반대|긍정|부정|옹호|비판)(?:측|파|론|층|여론|입장|쪽|적)?(?=$|\s)"
CATEGORY_TITLE = r"(?U)^(?:정치|경제|사회|국제|문화|스포츠|IT|연예)\s*(?:뉴스|소식|이슈|전체|종합)?$"
NAMING_CODES = {"empty": "empty", "time": "S-2 시간구분형", "attribute": "S-3 속성형", "event": "S-1 이벤트복사형", "parent": "S-4 부모동일범위형"}
SENTENCE_END =r"(?U)(?<=[.!?。！？])\s+"
TITLE_TAIL = r"(?U)[\s.,!?;:。！？，；：、]+$"
SUMMARY_SENTENCES, SUMMARY_CHARS, TITLE_CHARS = 4, 700, 30
TITLE_BREAK_SHARE, FOOTER_FROM, FOOTER_BACK, FOOTER_LEAST, LONG_TEXT = 0.65, 0.6, 150, 100, 8000


def clean_string(x: Column) -> Column:
    """Runs of Unicode white space to one space, trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"(?U)\s+", " "))


def last_index(text: Column, part: str) -> Column:
    """0-based place of the last occurrence, -1 if none."""
    at = F.instr(F.reverse(text), part[::-1])
    return F.when(at == 0, F.lit(-1)).otherwise(F.char_length(text) - at - (len(part) - 1))


def sentences(text: Column) -> Column:
    # a lambda, as transform would hand its index to a function of two parameters, and trim would take it as characters to trim
    return F.filter(F.transform(F.split(text, SENTENCE_END), lambda s: F.trim(s)), lambda s: s != "")


def first_sentences(x: Column, n: int = SUMMARY_SENTENCES) -> Column:
    text = clean_string(x)
    return F.array_join(F.slice(sentences(text), 1, n), " ")


def normalize_summary(x: Column, most_sentences: int = SUMMARY_SENTENCES, most_chars: int = SUMMARY_CHARS) -> Column:
    """The first sentences; if still too long, cut at the last sentence end in the second half, else with an ellipsis."""
    text = first_sentences(x, most_sentences) if most_sentences > 0 else clean_string(x)
    clipped = F.rtrim(F.substring(text, 1, most_chars))
    end = F.greatest(*[last_index(clipped, p) for p in (". ", "! ", "? ", "。", "！", "？")])
    short = F.when(end >= most_chars // 2, F.rtrim(F.substring(clipped, F.lit(1), end + 1))).otherwise(F.concat(F.rtrim(F.substring(clipped, 1, most_chars - 3)), F.lit("...")))
    return F.when(F.char_length(text) <= most_chars, text).otherwise(short)


def normalize_title(x: Column, most_chars: int = TITLE_CHARS) -> Column:
    """Quotes and trailing punctuation off; a long title is cut at a late break."""
    bare = F.regexp_replace(F.regexp_replace(clean_string(x), r"^[ \"'`]+", ""), r"[ \"'`]+$", "")
    text = F.regexp_replace(bare, TITLE_TAIL, "")
    clipped = F.rtrim(F.substring(text, 1, most_chars))
    end = F.greatest(*[last_index(clipped, p) for p in (" ", ",", "，", "、", "·")])
    cut = F.when(end >= int(most_chars * TITLE_BREAK_SHARE), F.rtrim(F.substring(clipped, F.lit(1), end))).otherwise(clipped)
    return F.when(F.char_length(text) <= most_chars, text).otherwise(F.regexp_replace(cut, TITLE_TAIL, ""))


def occurrences(text: Column, part: str) -> Column:
    return ((F.char_length(text) - F.char_length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once a row: a lambda's variable is not inlined, whatever number of times it is named."""
    return F.get(F.transform(F.array(value), use), 0)


def _words_in(low: Column, words: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in words]))


def keyword_hits(text: Column, words: list[str]) -> Column:
    """The words that occur, case-insensitively, in their order."""
    return once(F.lower(text), lambda low: _words_in(low, words))


def cleanup_reasons(x: Column) -> Column:
    """Why a text needs cleaning, in a fixed order; empty if it does not. The text is cleaned and lowered once a row."""

    def reasons(s: Column) -> Column:
        text, low = s["text"], s["low"]
        hits, strong = _words_in(low, BOILERPLATE), _words_in(low, STRONG_BOILERPLATE)
        related = sum((occurrences(text, w) for w in RELATED[1:]), occurrences(text, RELATED[0]))
        share = sum((occurrences(text, w) for w in SHARE[1:]), occurrences(text, SHARE[0]))
        found = F.array(
            F.when(F.char_length(text) > LONG_TEXT, F.lit("too_long")),
            once(hits, lambda h: F.when(F.size(h) >= 2, F.concat(F.lit("boilerplate_keywords:"), F.array_join(F.slice(h, 1, 5), ",")))),
            once(strong, lambda h: F.when(F.size(h) > 0, F.concat(F.lit("strong_boilerplate:"), F.array_join(F.slice(h, 1, 3), ",")))),
            F.when(related >= 2, F.lit("repeated_related_articles")),
            F.when(share >= 2, F.lit("share_ui_noise")),
        )
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array_compact(found))

    return once(clean_string(x), lambda text: once(F.struct(text.alias("text"), F.lower(text).alias("low")), reasons))


def strip_footer(text: Column) -> Column:
    """Cuts a copyright or tip-line footer that starts in the last 40 percent; a cut that leaves too little is not made."""
    n = F.char_length(text)
    start = F.floor(n * F.lit(FOOTER_FROM)).cast("int")
    tail = F.regexp_instr(F.substring(text, start + 1, n), F.lit(FOOTER))
    cut = start + tail - 1
    back = F.greatest(cut - FOOTER_BACK, F.lit(0))
    earlier = F.regexp_instr(F.substring(text, back + 1, cut - back), F.lit(FOOTER))
    at = F.when(earlier > 0, back + earlier - 1).otherwise(cut)
    kept = F.regexp_replace(F.substring(text, F.lit(1), at), "[ \\t\\n·\\-—,]+$", "")
    return F.when((tail > 0) & (F.char_length(kept) >= FOOTER_LEAST), kept).otherwise(text)


def labelled(*parts: tuple[str, Column]) -> Column:
    """`label: text` lines for the parts that are not empty."""
    return F.concat_ws("\n", *[F.when(clean_string(c) != "", F.concat(F.lit(f"{name}: "), clean_string(c))) for name, c in parts])


def is_time_title(x: Column) -> Column:
    return F.coalesce(x, F.lit("")).rlike(TIME_TITLE)


def is_attribute_title(x: Column) -> Column:
    return F.coalesce(x, F.lit("")).rlike(ATTRIBUTE_TITLE)


def is_category_title(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit(""))).rlike(CATEGORY_TITLE)


def naming_violation(title: Column, event_similarity: Column, parent_similarity: Column, copy: float = 0.90, scope: float = 0.85) -> Column:
    """The first rule that a subtopic title breaks, as its code, null if none. The similarities are those of the title to its
    event's and to its parent's title (`similarity.title_similarity`)."""
    return (
        F.when(F.coalesce(title, F.lit("")) == "", NAMING_CODES["empty"])
        .when(is_time_title(title), NAMING_CODES["time"])
        .when(is_attribute_title(title), NAMING_CODES["attribute"])
        .when(event_similarity >= copy, NAMING_CODES["event"])
        .when(parent_similarity >= scope, NAMING_CODES["parent"])
    )


def member_class(n: Column) -> Column:
    return F.when(n == 0, "none").when(n == 1, "single").otherwise("multi")


def bigrams(x: Column) -> Column:
    """Distinct pairs of neighbouring letters and digits, all else dropped."""
    text = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]", "")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text) - 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(2)))
    return F.when(F.char_length(text) < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(pairs))


def containment(a: Column, b: Column) -> Column:
    """Share of a's bigrams that b has; 0 without any."""
    own = bigrams(a)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(own, bigrams(b))), F.size(own)), F.lit(0.0))


def holds_quote(text: Column, quote: Column, least: int = 4) -> Column:
    """Whether a quote of enough letters occurs in the text, white space aside."""
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")
    return (F.char_length(bare(quote)) >= least) & F.contains(bare(text), bare(quote))
