from recordloom.llm.queries import URL_RULES
from recordloom.llm.urlrules import judge_urls

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, rule string, host string"


def judged(spark, urls, rules=URL_RULES, **kw):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)]
    out = judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, RULES), **kw)
    return [tuple(r)[1:] for r in out.orderBy("page_id").collect()]


def test_hosts_paths_and_longest_rule(spark):
    assert judged(
        spark,
        [
            "https://A.Example.ORG/es/x?q=1",
            "http://example.org/en/10#t",
            "http://example.org/en/20",
            "http://notorg/es/",
            "http://x.com/de/a?b/fr/",
            "ftp://x.com",
            "http://x.com?u=http://y.org/",
            None,
            "",
            "no scheme.org/es/",
        ],
    ) == [
        ("a.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "/en/10", "example.org/en/1", "block"),
        ("example.org", "/en/20", "org/", "allow"),
        ("notorg", "/es/", None, "allow"),
        ("x.com", "/de/a", "com/de/", "block"),
        ("x.com", "", None, "allow"),
        ("x.com", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
    ]


def test_ties_nulls_and_defaults(spark):
    rules = [("a.b", "/", "allow"), ("a.b", "/", "block"), (None, "/", "block"), ("c", None, "allow")]
    got = judged(spark, ["x://a.b/", "x://z/" + "y" * 5000, "x://c", "x://é.c/ü\n/x"], rules, default="block")
    assert [g[2:] for g in got] == [("a.b/", "block"), (None, "block"), ("c", "allow"), ("c", "allow")]
    assert got[3][:2] == ("é.c", "/ü\n/x")


def test_repeated_rows_empty_tables(spark):
    page = spark.createDataFrame([(1, "x://a.org/", "", "")] * 3 + [(None, None, None, None)], PAGES)
    assert judge_urls(page, spark.createDataFrame(URL_RULES, RULES)).count() == 4
    assert judge_urls(page, spark.createDataFrame([], RULES)).filter("rule is null").count() == 4
    assert judge_urls(page.limit(0), spark.createDataFrame(URL_RULES, RULES)).collect() == []
