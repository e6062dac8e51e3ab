from pyspark.sql import functions as F

from reviewlens.functions import coerce as co
from reviewlens.functions import text as tx
from reviewlens.operators import sentiment as se
from reviewlens.operators import topics as tp


def test_clean(one):
    assert one("t string", ("a\\nb\\r\\n  c\t\n d ",), tx.clean(F.col("t"))) == ["a b c d"]
    for token in ("nan", "None", "", "  "):
        assert one("t string", (token,), tx.clean(F.col("t"))) == [None]


def test_strip_takes_every_kind_of_space(one):
    assert one("t string", ("   x　\n",), co.strip(F.col("t"))) == ["x"]


def test_title_leak(one):
    leaked = "I see what is happening. Powerful Yet Pricey ERP with"
    assert one("t string", (leaked,), tx.strip_title(F.col("t")), tx.has_title_leak(F.col("t"))) == [
        "I see what is happening.", True,
    ]
    for fine in ("It ends well. Powerful yet pricey.", "Short. Nope", "lower. case title here and more"):
        assert one("t string", (fine,), tx.strip_title(F.col("t")), tx.has_title_leak(F.col("t"))) == [fine, False]


def test_abbreviations(one):
    expand = tx.expand_abbreviations(F.col("t"))
    cases = {
        "AP aging": "accounts payable aging report",
        "fp&a, P&L": "financial planning and analysis, profit and loss",
        "1099 and W-2 or w2": "1099 tax form and w2 payroll form or w2 payroll form",
        "SKUs kpi KPIs": "stock keeping unit key performance indicator key performance indicator",
        "maps éap apé soup": "maps éap apé soup",
        "PO pos so": "purchase order point of sale sales order",
        "nothing here": "nothing here",
    }
    for text, want in cases.items():
        assert one("t string", (text,), expand) == [want]


def test_topic_texts_gate_after_expansion(spark):
    rows = [
        ("likes", "short"),
        ("likes", "GL " * 6),  # short as written, long enough once expanded
        ("use_case", "A long enough use case that keeps its first half. Some Leaked Title of it"),
        ("likes", "A long enough liked text that keeps its second half. Some Leaked Title of it"),
        ("likes", "None"),
    ]
    got = [r.text for r in tp.topic_texts(spark.createDataFrame(rows, "text_field string, text string")).collect()]
    assert got[0] is None and got[4] is None
    assert got[1] == ("general ledger " * 6).strip()
    assert got[2] is None  # 49 characters once the title is gone
    assert got[3].endswith("Title of it")


def test_aspect_terms(one):
    aspect = tx.aspect_term(F.col("t"))
    cases = {
        "Financial Reporting & Business Intelligence": "financial reporting business intelligence",
        "Implementation, Setup & Cost Management": "implementation setup cost management",
        "A/B\\C | D": "a b c d",
        None: "general",
    }
    for label, want in cases.items():
        assert one("t string", (label,), aspect) == [want]


def sentences(spark, text):
    df = spark.createDataFrame([("r", text)], "review_id string, text string")
    return [tuple(r) for r in se.split_sentences(df).select("sentence", "sentence_idx", "n_sentences").collect()]


def test_sentences(spark):
    assert sentences(spark, "Great reports here. Support is slow. ") == [
        ("Great reports here.", 0, 2), ("Support is slow.", 1, 2),
    ]
    assert sentences(spark, "Works with v2.0 and U.S.A. rules! really so") == [
        ("Works with v2.0 and U.S.A. rules! really so", 0, 1)
    ]
    assert sentences(spark, "Short one. No. This one is long enough.") == [("This one is long enough.", 0, 1)]
    assert sentences(spark, "Too short. So it. Is.") == [("Too short. So it. Is.", 0, 1)]
    assert sentences(spark, "Tiny. Bit") == []
    assert sentences(spark, "") == []


def test_terms(spark):
    df = spark.createDataFrame([("The GL report, a fast-report!",), ("the",), (None,)], "text string")
    got = [r.terms for r in tp.with_terms(df, ["the"]).collect()]
    assert got[0] == ["gl", "report", "fast", "report", "gl report", "report fast", "fast report"]
    assert got[1] == [] and got[2] is None


def test_keywords(one):
    kw = F.col("k")
    assert one("k string", ("alpha, beta,gamma, delta",), tx.label_of(kw)) == ["alpha | beta | gamma"]
    assert one("k string", ("unlabelled",), tx.label_of(kw)) == ["unlabelled"]
    assert one("k string", ("navigate, easy navigate, navigation",), tx.names_only_products(kw)) == [True]
    assert one("k string", ("navigate, easy navigate, navigation",), tx.names_only_products(kw, mode="token")) == [False]
    assert one("k string", ("oracle cloud, bank, sap",), tx.names_only_products(kw)) == [False]


def test_relevance_is_by_substring(one):
    got = one("s string, k string", ("Reporting is slow", "report, bank, slow, "), tx.keyword_overlap(F.col("s"), F.col("k")))
    assert got == [2 / 3]
    assert one("s string, k string", ("x", ""), tx.keyword_overlap(F.col("s"), F.col("k"))) == [None]


def test_json_payload(one):
    cases = {
        '{"a": 1}': "1",
        'Sure:\n```json\n{"a": 2}\n```': "2",
        "```\n{\"a\": 3}\n```": "3",
        '<reasoning>because</reasoning><output> {"a": 4} </output>': "4",
        "no json": None,
    }
    for text, want in cases.items():
        assert one("t string", (text,), F.try_variant_get(tx.json_payload(F.col("t")), "$.a", "string")) == [want]
    assert one("t string", ("<reasoning> so </reasoning>",), tx.reasoning(F.col("t"))) == ["so"]
