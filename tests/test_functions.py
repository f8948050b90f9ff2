import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinlake.operators import content
from opinlake.functions import html as H
from opinlake.functions import text as T
from opinlake.functions import times as C
from opinlake.functions import url as U

URLS = [
    ("https://EXAMPLE.com/Path?a=1&utm_source=x&b=2&utm_campaign=y", "https://example.com/Path?a=1&b=2"),
    ("http://example.com:80/index.html?", "http://example.com/index.html"),
    ("https://www.bobaedream.co.kr/view?code=freeb&No=3336459&bm=1&cmt=1&utm_source=x", "https://www.bobaedream.co.kr/view?No=3336459&code=freeb"),
    ("https://mlbpark.donga.com/mp/b.php?b=bullpen&m=view&id=202511030110552085&utm_source=x", "https://mlbpark.donga.com/mp/b.php?b=bullpen&id=202511030110552085"),
    ("https://www.kmib.co.kr/article/view.asp?arcid=0924244207&code=11151100&sid1=eco", "https://www.kmib.co.kr/article/view.asp?arcid=0924244207&code=11151100"),
    ("http://moneys.mt.co.kr/news/mwView.php?no=2019103114188092934&code=&MGSPN", "http://moneys.mt.co.kr/news/mwView.php?no=2019103114188092934"),
    ("https://news.mt.co.kr/hotview.php?no=2024101408290989806&type=1&sec=all&hcnt=83", "https://news.mt.co.kr/hotview.php?no=2024101408290989806"),
    ("https://www.koreaherald.com/view.php?ud=20241018050378&np=1&mpv=0", "https://www.koreaherald.com/view.php?ud=20241018050378"),
    ("https://theqoo.net/square/4005485178?page=6", "https://theqoo.net/square/4005485178"),
    ("https://example.com/article?no=123&page=5&foo=bar", "https://example.com/article?no=123"),
]


URLS += [  # blank values, parameters of the last segment, an empty path, no scheme, ports, users, repeated and encoded names
    ("https://e.com/x?a=&b=1", "https://e.com/x?a=&b=1"),
    ("https://e.com/x?flag&b=1", "https://e.com/x?b=1&flag="),
    ("https://e.com/x;v=1?b=1", "https://e.com/x?b=1"),
    ("https://e.com/d;v=1/x", "https://e.com/d;v=1/x"),
    ("HTTPS://User@E.com:443", "https://e.com/"),
    ("https://e.com:8080?b=2&a=1", "https://e.com:8080/?a=1&b=2"),
    ("//e.com/x#top", "http://e.com/x"),
    ("https://e.com/x?b=2&a=%20z&b=1", "https://e.com/x?a= z&b=1&b=2"),
    ("https://e.com/x?", "https://e.com/x"),
    ("https://amt.co.kr/mtview.php?no=1&x=2", "https://amt.co.kr/mtview.php?no=1"),
]


def test_url_plan_is_small(spark):
    """The URL is parsed once, whatever the number of site rules."""
    df = spark.createDataFrame([("https://e.com/x?a=1",)], "url string").select(U.normalize(F.col("url")).alias("n"))
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 12_000


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("url", "want"), URLS)
def test_normalize(spark, url, want):
    assert one(spark, url, U.normalize) == want


def test_url_others(spark):
    assert one(spark, "https://A.com/x?utm_a=1&b=a~b&fbclid=2", U.article_key) == "//a.com/x?b=a~b"
    assert one(spark, "https://a.com/x?page=1&b=2", lambda c: U.set_param(c, "page", F.lit(3))) == "https://a.com/x?b=2&page=3"
    assert one(spark, None, U.normalize) is None and one(spark, None, U.article_key) is None
    assert one(spark, "https://A.com/x//?a=&utm_b=1;c", U.article_key) == "//a.com/x?a=" and one(spark, "https://a.com/", U.article_key) == "//a.com"


def test_text(spark):
    assert one(spark, "body © tail", T.cut_tail) == "body "
    assert one(spark, "© tail", T.cut_tail) == "© tail"
    assert one(spark, "a\r\n\r\n\r\n\r\nb  c　", T.squeeze) == "a\n\nb c"
    assert one(spark, "Head | Site - More", T.title_key) == "head"
    assert one(spark, "Head|a|b", T.title_tail) == "Head"
    assert one(spark, "Head|" + "x" * 31 + "|b", T.title_tail) == "Head|" + "x" * 31
    assert one(spark, "Threads: @me\nreal line\nall rights reserved\nsee https://a.b c", T.web_noise) == "real line see c"
    assert one(spark, "첫줄\n\n둘째", T.first_paragraph) == "첫줄"
    for w, bad in (("bwbkgxz", True), ("pension", False), ("fxgiyxj", True), ("nps", False), ("aaaaabbb", True)):
        assert one(spark, w, T.is_gibberish) is bad
    for h, want in ((0, "오전 12시"), (13, "오후 1시"), (12, "오후 12시")):
        assert spark.range(1).select(T.hour_label(F.lit(h)).alias("y")).first()["y"] == want
    assert spark.createDataFrame([("a : MLBPARK", "mlbpark"), ("더쿠 - 제목", "theqoo"), ("x", "other")], "t string, s string").select(T.site_title(F.col("t"), F.col("s")).alias("y")).toPandas()["y"].tolist() == ["a", "제목", "x"]


def test_times(spark):
    assert one(spark, "2025-11-23T14:30:00+09:00", C.lenient_ntz) == dt.datetime(2025, 11, 23, 14, 30)
    assert one(spark, "2025", C.lenient_ntz) is None
    assert one(spark, "20251123T143000Z", C.iso_utc) == "2025-11-23T14:30:00Z"
    assert one(spark, "2025-11-23T14:30:00+09:00", C.iso_utc) == "2025-11-23T05:30:00Z"
    assert one(spark, "02.29 10:00:00", lambda c: C.forum_time(c, F.lit(2024))) is None
    assert one(spark, "수정 25.11.16 09:56 | 내용", lambda c: F.array_max(C.mentions(c)[0])) == dt.datetime(2025, 11, 16, 9, 56)
    assert one(spark, "2025.11.22 13:17:43 그리고 25/11/24", lambda c: F.array_max(C.mentions(c)[0])) == dt.datetime(2025, 11, 22, 13, 17, 43)


def test_loose_times(spark):
    at = lambda *x: dt.datetime(*x)
    for text, want in (("수정 25.11.16 09:56 | 내용", at(2025, 11, 16, 9, 56)), ("(목) 2025/11/02 (x) 13:00:07", at(2025, 11, 2, 13, 0, 7)), ("71-3-4", at(1971, 3, 4)), ("69.3.4", at(2069, 3, 4)), ("at 20251123T143000Z now", at(2025, 11, 23, 14, 30)), ("2025-11-23T14:30:00Z", at(2025, 11, 23, 14, 30)), ("2025-13-40", None), ("", None), (None, None), ("x", None)):
        assert one(spark, text, C.loose) == want, text
    for text, want in (("25.11.16 09:56", at(2025, 11, 16, 9, 56)), ("2025-11-02", at(2025, 11, 2)), ("69/1/2", at(1969, 1, 2)), ("68-01-02 3:04:05", at(2068, 1, 2, 3, 4, 5)), ("2025년11월02일", at(2025, 11, 2)), ("2025.11-02", at(2025, 11, 2)), ("20251102130509", at(2025, 11, 2, 13, 5, 9)), ("25.13.01", None), ("", None), (None, None)):
        assert one(spark, text, C.listing) == want, text
    assert one(spark, "앞 갤러리 본문 영역 글 하단 갤러리 리스트 영역 뒤", content.between_markers) == "글" and one(spark, None, content.between_markers) == ""


def test_html(spark):
    page = "<html><head><meta property='og:title' content='정상 제목'><title>other</title></head><body><div class='rd_body'>첫줄 <img src='x' alt='그림'><p>둘째</p></div><script>x</script></body></html>"
    assert one(spark, page, H.title) == "정상 제목"
    assert one(spark, page, lambda c: H.body_text(c, "rd_body")) == "첫줄 그림 둘째"
    assert "x" not in one(spark, "<script>x</script><b>y</b>", H.strip_tags)
