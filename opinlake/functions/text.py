"""Text functions on Columns; all stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers after which an article or a video description is no longer content.
ARTICLE_TAILS = ("all rights reserved", "무단 전재 및 재배포 금지", "©")
VIDEO_TAILS = ("yt-support-solutions-kr@google.com", "YouTube 상에 게시, 태그 또는 추천한 상품들은", "유튜브 상에 게시, 태그 또는 추천한 상품들은", "불법촬영물 신고", "저작권 침해 신고", "© 20", "Google LLC")
# Patterns of web noise.
URL_PATTERN = r"(?i)(https?://[^\s]+|www\.[^\s]+)"
EMAIL_PATTERN = r"(?i)[a-z0-9_.\-+]+@[a-z0-9_.\-]+\.[a-z0-9_]+"
SOCIAL_PATTERN = r"(?i)^(thread|threads|instagram|facebook|twitter|tiktok|kakaotalk|email|e-mail)\s*[:\-]"
BOILERPLATE_PATTERN = r"(?i)(all\s+rights\s+reserved|copyright|unauthorized\s+reproduction|reproduction|redistribution|무단\s*(전재|복제|재배포)|전재|재배포|ai\s*학습|학습\s*이용\s*금지)"
EVENT_KEYWORDS = ("이벤트", "쿠폰", "체험단", "핫딜", "세일", "특가")
WORD = r"[\p{L}\p{N}_]+"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$", "")


def unix_lines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def squeeze(c: Column) -> Column:
    """At most one empty line, single blanks inside lines, stripped."""
    x = F.regexp_replace(unix_lines(c), r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(x, r"[ \t]{2,}", " "))


def cut_tail(c: Column, markers: tuple[str, ...] = ARTICLE_TAILS) -> Column:
    """Up to the earliest marker; a text that begins with one stays whole."""
    low = F.lower(c)
    at = [F.nullif(F.instr(low, m.lower()), F.lit(0)) for m in markers]
    first = F.least(*at) if len(at) > 1 else at[0]
    return F.when(first > 1, F.substring(c, F.lit(1), first - 1)).otherwise(c)


def fold(c: Column) -> Column:
    """Lower case, everything but letters and digits one blank."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def tokens(c: Column) -> Column:
    """The set of words, lower case, in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), F.lit(1)))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; 0 where one is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def title_key(c: Column) -> Column:
    """A title before any site suffix, lower case."""
    x = reduce(lambda t, sep: F.substring_index(t, sep, 1), (" - ", "｜", " | ", "|"), c)
    return F.trim(F.regexp_replace(F.lower(x), r"\s+", " "))


def title_tail(c: Column, most: int = 30) -> Column:
    """A title without trailing segments after a bar of at most ``most`` characters, however many follow one another."""
    parts = F.split(c, r"\|")
    # from the end, segments go while each is short; the first one always stays
    kept = F.aggregate(
        F.reverse(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))),
        F.array().cast("array<string>"),
        lambda acc, s: F.when((F.size(acc) == 0) & (F.length(F.trim(s)) <= most), acc).otherwise(F.concat(acc, F.array(s))),
    )
    return F.trim(F.array_join(F.concat(F.slice(parts, 1, 1), F.reverse(kept)), "|"))


def hashtags_to_words(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"#({WORD})", "$1"), r"[ \t]{2,}", " "))


def without_hashtags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"#[^\s]+", " "), r"\s+", " "))


def first_paragraph(c: Column) -> Column:
    return strip(F.substring_index(unix_lines(c), "\n\n", 1))


def web_noise(c: Column) -> Column:
    """Without promotional and legal lines, addresses and app tags, in one line."""
    lines = F.filter(F.transform(F.split(unix_lines(c), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    social = lambda x: x.rlike(SOCIAL_PATTERN) & (x.rlike(URL_PATTERN) | F.contains(x, F.lit("@")) | F.contains(F.lower(x), F.lit("threads.com")))
    kept = F.filter(lines, lambda x: ~social(x) & ~x.rlike(BOILERPLATE_PATTERN))
    t = F.array_join(kept, " ")
    for p in (URL_PATTERN, EMAIL_PATTERN, r"(?i)dc\s+official\s+app"):
        t = F.regexp_replace(t, p, " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def korean_english_only(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^가-힣A-Za-z0-9\s]", " "), r"\s+", " "))


def is_gibberish(w: Column) -> Column:
    """Whether a lower-case Latin token looks random: too long, too few vowels, long consonant runs or one letter over and over."""
    n = F.length(w)
    v = n - F.length(F.translate(w, "aeiou", ""))
    often = F.exists(F.array(*[F.lit(chr(97 + i)) for i in range(26)]), lambda ch: n - F.length(F.replace(w, ch, F.lit(""))) >= 5)
    return ~w.rlike("^[a-z]+$") | (n >= 22) | ((n >= 7) & (v <= 1)) | ((n >= 10) & (v / n < 0.22)) | ((n >= 9) & w.rlike("[^aeiou]{5,}")) | ((n >= 8) & often)


def site_title(c: Column, source: Column) -> Column:
    """Titles without what single sites add before or after them."""
    suffix = F.regexp_replace(c, r" - 국민연금 마이너 갤러리$", "")
    ball = F.regexp_replace(F.regexp_replace(c, r"(?i)\s*:\s*MLBPARK\s*$", ""), r"\s*추천\s*\d+\s*공유\s*$", "")
    prefixed = F.when(F.lower(F.trim(F.substring_index(c, " - ", 1))).rlike("^(더쿠|theqoo)") & F.contains(c, F.lit(" - ")), F.regexp_replace(c, r"^.*? - ", "")).otherwise(c)
    return F.trim(F.when(source == "dcinside", suffix).when(source == "mlbpark", ball).when(source == "theqoo", prefixed).otherwise(c))


def hour_label(h: Column) -> Column:
    """An hour of the day in the Korean twelve-hour form."""
    return F.concat(F.when(h < 12, F.lit("오전 ")).otherwise(F.lit("오후 ")), F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12).cast("string"), F.lit("시"))
