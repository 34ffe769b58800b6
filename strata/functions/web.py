"""URL, image and feed expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, in order of precedence.
CATEGORIES = [
    ("정치", ["politics", "politic", "polrss", "정치", "segye_politic", "sectionid=01", "section/65"]),
    ("경제", ["economy", "economic", "eco", "경제", "business", "30100041", "30200030", "50200011", "sectionid=02", "section/66", "eto/economy"]),
    ("국제", ["international", "world", "global", "kh_world", "intrss", "국제", "세계", "sectionid=07", "section/68", "eto/global", "northkorea", "north-korea", "북한"]),
    ("사회", ["society", "social", "national", "soc", "사회", "50400012", "30300018", "50100032", "sectionid=03", "section/67", "industry", "산업", "eto/industry"]),
]
DEFAULT_CATEGORY = "사회"
PUBLISHERS = [
    ("조선일보", "보수", "chosun.com"),
    ("연합뉴스", "중도", "yna.co.kr"),
    ("연합뉴스TV", "중도", "yonhapnewstv.co.kr"),
    ("한국경제", "보수", "hankyung.com"),
    ("서울신문", "중도", "seoul.co.kr"),
    ("오마이뉴스", "진보", "ohmynews.com"),
    ("매일경제", "보수", "mk.co.kr"),
    ("경향신문", "진보", "khan.co.kr"),
    ("국민일보", "보수", "kmib.co.kr"),
    ("뉴시스", "중도", "newsis.com"),
    ("동아일보", "보수", "donga.com"),
    ("세계일보", "보수", "segye.com"),
    ("프레시안", "진보", "pressian.com"),
    ("한겨레", "진보", "hani.co.kr"),
    ("JTBC", "진보", "jtbc.co.kr"),
    ("SBS", "중도", "sbs.co.kr"),
    ("이투데이", "중도", "etoday.co.kr"),
    ("MBN", "보수", "mbn.co.kr"),
]
DEFAULT_PUBLISHER, DEFAULT_BIAS = "기타", "중도"
ICON_ENDINGS = [".svg", ".ico"]
PROFILE_SEGMENTS = ["reporter", "writer"]
PLACEHOLDER_STEMS = ["transparent", "white"]
NOISE_TOKENS = ["ad", "ads", "advert", "avatar", "banner", "blank", "btn", "button", "caution", "default", "dummy", "facebook", "icon", "kakao", "logo", "myagent", "noimg", "pixel", "placeholder", "profile", "share", "sns", "spacer", "sprite", "twitter", "videojs", "watermark"]
SMALL_WIDTH, SMALL_HEIGHT = 120, 80


def _target(url: Column, title: Column | None) -> Column:
    return F.lower(F.concat(F.coalesce(url, F.lit("")), F.lit(" "), F.coalesce(title, F.lit("")) if title is not None else F.lit("")))


def category(url: Column, title: Column | None = None) -> Column:
    target, out = _target(url, title), None
    for label, words in CATEGORIES:
        hit = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(target, w))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(DEFAULT_CATEGORY)


def publisher(url: Column, title: Column | None = None) -> Column:
    """struct(publisher, bias): the first pattern that occurs."""
    target, out = _target(url, title), None
    for name, bias, pattern in PUBLISHERS:
        value = F.struct(F.lit(name).alias("publisher"), F.lit(bias).alias("bias"))
        out = F.when(F.contains(target, F.lit(pattern)), value) if out is None else out.when(F.contains(target, F.lit(pattern)), value)
    return out.otherwise(F.struct(F.lit(DEFAULT_PUBLISHER).alias("publisher"), F.lit(DEFAULT_BIAS).alias("bias")))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def under_domain(name: Column, domain: str) -> Column:
    return (name == domain) | F.endswith(name, F.lit("." + domain))


def looks_like_url(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit(""))).rlike(r"(?i)^https?:")


def srcset_first(x: Column) -> Column:
    """The first URL among comma-separated candidates, empty if none."""
    urls = F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda c: F.element_at(F.split(F.trim(c), " "), 1)), lambda u: u != "")
    return F.coalesce(F.try_element_at(urls, F.lit(1)), F.lit(""))


def without_dots(rooted: Column) -> Column:
    """A rooted path with its `.` and `..` segments resolved; one that ends in them is a folder."""
    parts = F.split(rooted, "/")
    parts = F.slice(parts, F.lit(2), F.size(parts))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    folder = F.when(rooted.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, folder), "/"))


def normalize_image_url(value: Column, base: Column) -> Column:
    """Absolute URL with an allowed scheme, else empty. Covers scheme-less, rooted, relative and absolute values, dot segments
    and values of a query or a fragment alone."""
    v = F.trim(F.coalesce(value, F.lit("")))
    scheme = F.regexp_extract(F.coalesce(base, F.lit("")), r"^(https?):", 1)
    root = F.regexp_extract(F.coalesce(base, F.lit("")), r"^(https?://[^/?#]*)", 1)
    asked = F.regexp_extract(F.coalesce(base, F.lit("")), r"^[^?#]*(\?[^#]*)", 1)
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    own, tail = F.regexp_extract(v, r"(?s)^([^?#]*)(.*)$", 1), F.regexp_extract(v, r"(?s)^([^?#]*)(.*)$", 2)
    out = (
        F.when((v == "") | v.rlike(r"^(?:data|blob|javascript):"), "")
        .when(F.startswith(v, F.lit("//")), F.concat(F.when(scheme != "", scheme).otherwise(F.lit("https")), F.lit(":"), v))
        .when(v.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), v)
        .when(root == "", v)
        .when(F.startswith(v, F.lit("/")), F.concat(root, without_dots(own), tail))
        .when(own == "", F.concat(root, path(base), F.when(F.startswith(v, F.lit("#")), asked).otherwise(""), tail))
        .otherwise(F.concat(root, without_dots(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), own)), tail))
    )
    return F.when(out.rlike(r"^(?:https?|file):"), out).otherwise("")


def unwanted_image(url: Column) -> Column:
    """Icons, profile pictures, placeholders and interface images, by ending, path segment, file stem and tokens."""
    p = F.lower(path(url))
    segments = F.filter(F.split(p, "/"), lambda s: s != "")
    stem = F.regexp_replace(F.regexp_replace(F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit("")), r"(?<=.)\.[^.]*$", ""), r"[-_][0-9]+$", "")
    text = F.regexp_replace(F.concat(host(url), F.lit("/"), p), r"[_.]", "-")
    tokens = F.transform(F.split(text, r"[/-]"), lambda t: F.regexp_replace(F.trim(t), r"[0-9]+$", ""))
    return (
        F.exists(F.array(*[F.lit(e) for e in ICON_ENDINGS]), lambda e: F.endswith(p, e))
        | F.arrays_overlap(segments, F.array(*[F.lit(s) for s in PROFILE_SEGMENTS]))
        | stem.isin(PLACEHOLDER_STEMS)
        | F.arrays_overlap(tokens, F.array(*[F.lit(t) for t in NOISE_TOKENS]))
    )


def small_image(width: Column, height: Column) -> Column:
    """Both sizes known and one of them too small; a size is the digits of its value, so that `100px` is 100."""
    digits = lambda c: F.regexp_replace(c.cast("string"), "[^0-9]", "")
    size = lambda c: F.when(F.char_length(digits(c)) > 18, F.lit(10**18)).otherwise(digits(c).try_cast("long"))
    w, h = size(width), size(height)
    return F.coalesce((w < SMALL_WIDTH) | (h < SMALL_HEIGHT), F.lit(False)) & w.isNotNull() & h.isNotNull()
