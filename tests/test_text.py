"""Text, date, number and score expressions on hand-written values."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from docgraph.functions import fixed
from docgraph.functions import scores as S
from docgraph.functions import text


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return row.select(expr).first()[0]


def test_document_numbers(spark):
    body = "依据发改办能源〔2024〕718号和国办发[2020] 39 号,以及沪府（2022）第 5号。另见发改办能源〔2024〕 718 号"
    got = one(spark, text.doc_numbers("b"), b=body)
    assert got == ["发改办能源〔2024〕718号", "国办发〔2020〕39号", "沪府〔2022〕5号"]


def test_document_numbers_of_known_issuers(spark):
    body = "落实和政发〔2020〕1号、见国办发〔2021〕2号,详见某发〔2022〕3号"
    assert one(spark, text.doc_numbers("b", ["和政发", "政发", "国办发"]), b=body) == [
        "和政发〔2020〕1号", "国办发〔2021〕2号", "某发〔2022〕3号"]


def test_document_number_none(spark):
    assert one(spark, text.doc_numbers("b"), b="no number here 2024") == []


def test_dates_by_method(spark):
    def date(url="", body="", title=""):
        got = one(spark, text.extract_date(F.col("u"), F.col("b"), F.col("t")), u=url, b=body, t=title)
        return got and (got.date, got.method)

    day = dt.date(2024, 1, 5)
    assert date("https://a.cn/2024-01-05/x.html") == (day, "url_path_pattern")
    assert date("https://a.cn/t20240105_9.html") == (day, "url_path_pattern")
    assert date("https://a.cn/202401/x.html") == (dt.date(2024, 1, 1), "url_path_month_only")
    assert date(body="发布时间:2024-1-5") == (day, "body_publish_time")
    assert date(body="于2024年1月5日印发") == (day, "body_chinese_date")
    assert date(title="通知(2024.1.5)") == (day, "title_extract")
    assert date("https://a.cn/2024/x.html") == (dt.date(2024, 1, 1), "url_year_only")
    assert date("https://a.cn/2024/x.html", "2023年2月3日") == (dt.date(2023, 2, 3), "body_chinese_date")
    assert date("https://a.cn/2024-13-45/") is None


def test_timestamps(spark):
    for spelled in ("2026-04-25T11:07:53", "2026-04-25 11:07:53", "2026-04-25T19:07:53+08:00",
                    "2026-04-25 19:07:53+08:00"):
        assert one(spark, F.date_format(text.timestamp("v"), "yyyy-MM-dd HH:mm:ss"), v=spelled) \
            == "2026-04-25 11:07:53"
    assert one(spark, text.timestamp("v"), v="yesterday") is None


def test_host(spark):
    assert one(spark, text.host("v"), v="https://user@WWW.ndrc.gov.cn:8080/a?b#c") == "www.ndrc.gov.cn"
    assert one(spark, text.host("v"), v="not a url") is None


def test_titles_and_links(spark):
    assert one(spark, text.norm_title("v"), v="《车网互动 实施意见》(试行)") == "车网互动实施意见"
    assert one(spark, text.wiki_links("v"), v="见 [[文件名|P_2024_A_1]] 与 [[P_2]]") == ["P_2024_A_1", "P_2"]
    assert one(spark, text.headings("v"), v="## 政策原文\n### 一\n## 摘要 \nx") == ["政策原文", "摘要"]


def test_snippet_and_location(spark):
    assert one(spark, text.snippet(F.col("t"), F.col("h"), 3), t="abcdefghij", h="ef") == "bcdefghi"
    assert one(spark, text.snippet(F.col("t"), F.col("h"), 3), t="abc", h="zz") is None
    assert [one(spark, text.location(F.lit(p), F.lit(10000))) for p in (1, 800, 801, 9000, 9001)] == [
        "opening", "opening", "body", "body", "supplementary"]


def test_blank_markers(spark):
    assert [one(spark, text.blank_to_null("v"), v=v) for v in ("", " ", "~", " a ")] == [None, None, None, "a"]


def test_terms_and_style(spark):
    assert one(spark, text.term_hits("v", fixed.CLAIM_WORDS), v="全国首批试点,首个标杆") == ["首批", "首个", "标杆"]
    assert one(spark, text.sanitize("v"), v="A 立即: 动作🚀") == "A 趁早: 动作"


def test_importance_is_the_rounded_mean_for_all_scores(spark):
    data = list(itertools.product(range(6), repeat=3))
    df = spark.createDataFrame(data, "a int, b int, c int")
    got = df.select("a", "b", "c", S.importance(F.col("a"), F.col("b"), F.col("c"))).collect()
    for a, b, c, score in got:
        assert score == round(a * 0.4 + b * 0.4 + c * 0.2)
    by = {(a, b, c): s for a, b, c, s in got}
    assert all(by[a, b, c] <= by[min(a + 1, 5), b, c] for a, b, c in by)


def test_action_class(spark):
    def cls(*d):
        return one(spark, S.action_class(*[F.lit(x) for x in d]))
    assert [cls(4, 4, 3), cls(4, 3, 3), cls(3, 4, 3), cls(3, 3, 3)] == list("ABCD")
    assert [cls(4, 4, 5), cls(4, 3, 4), cls(3, 4, 2), cls(3, 3, 1)] == list("AADD")
    assert cls(3, 3, 4) == "C"


def test_display_and_triage(spark):
    assert [one(spark, S.display_class(F.lit(s), F.lit(True))) for s in (5, 4, 3, 2)] == list("ABCD")
    assert one(spark, S.display_class(F.lit(5), F.lit(False))) == "D"
    assert one(spark, S.triage(F.lit(False), F.lit(True), F.lit(True))) == "note"
    assert one(spark, S.triage(F.lit(True), F.lit(False), F.lit(True))) == "study first"
