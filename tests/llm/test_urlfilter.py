import pytest

from acctpulse.llm import urlfilter
from acctpulse.llm.queries import PLACE_RULES

URLS = {
    "http://Blog.Example.NET/en/1?x=net": ("blog.example.net", "/en/1", "example.net/en/", "allow"),
    "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
    "http://example.net": ("example.net", "", None, "allow"),
    "http://example.net?a/b": ("example.net", "", None, "allow"),
    "http://notexample.com/de/x": ("notexample.com", "/de/x", None, "allow"),
    "http://example.com/de": ("example.com", "/de", None, "allow"),
    "http://example.com/DE/x": ("example.com", "/DE/x", None, "allow"),
    "ftp://x.org/fr/a#b": ("x.org", "/fr/a", "org/fr/", "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "http://a.b/http://example.net/": ("a.b", "/http://example.net/", None, "allow"),
    "https://www.Spam-farm.example.org/en": ("www.spam-farm.example.org", "/en", None, "block"),
    "https://spamming.org/en": ("spamming.org", "/en", None, "allow"),
    "https://a.org/spam": ("a.org", "/spam", None, "allow"),
    "example.net/en/": ("", "", None, "allow"), "": ("", "", None, "allow"),
    "http://": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "://x.net/\n/y?": ("x.net", "/\n/y", "net/", "block"),
}


@pytest.mark.parametrize("max_inline", [500, 0])
def test_verdicts(spark, max_inline):
    rules = PLACE_RULES + urlfilter.DEFAULT_RULES
    data = [(i, u, 7) for i, u in enumerate([*URLS, *URLS])]  # every row twice
    urls = spark.createDataFrame(data, "page_id int, url string, token int")
    rows = urlfilter.judge(urls, rules, max_inline=max_inline).collect()
    assert len(rows) == len(data)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["url"]], r["url"]


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = [urlfilter.place_rule("block", "example.net/en/"), urlfilter.place_rule("allow", "net/")]
    data = [("http://example.net/en/",), ("http://example.net/de/",), ("http://b.org/en/x",),
            ("http://example.com/",)]
    urls = spark.createDataFrame(data, "url string")
    index = urlfilter.rarest_tokens(urls, rules)
    assert {t: [r.name for r in rs] for t, rs in index.items()} == {"en": ["example.net/en/"], "net": ["net/"]}


def test_rules_without_tokens_and_no_rules(spark):
    urls = spark.createDataFrame([("http://a.b/c",)], "url string")
    any_rule = urlfilter.Rule("any", "block", r"^http", ())
    for most in (500, 0):
        assert urlfilter.judge(urls, [any_rule], max_inline=most).first()["verdict"] == "block"
        assert urlfilter.judge(urls.limit(0), [any_rule], max_inline=most).count() == 0
    assert urlfilter.judge(urls, []).first()["verdict"] == "allow"


@pytest.mark.parametrize("max_inline", [500, 0])
def test_words_end_at_letters_beyond_ascii_and_names_may_clash(spark, max_inline):
    data = [("http://spamé.com/x", "h", 1), ("http://éspam.com/x", "h", 2), ("http://spams.com/", "h", 3), ("http://a.b/" + "x/" * 500_000, "h", 4)]
    urls = spark.createDataFrame(data, "url string, host string, verdict int").selectExpr("*", "verdict as n", "'r' as rule")
    rows = urlfilter.judge(urls, urlfilter.DEFAULT_RULES, max_inline=max_inline)
    assert rows.columns == ["url", "n", "host", "path", "rule", "verdict"]
    assert {r.n: r.verdict for r in rows.collect()} == {1: "block", 2: "block", 3: "allow", 4: "allow"}
    assert rows.where("host = 'a.b'").first().path == "/" + "x/" * 500_000


LINES = """! a comment
[Adblock Plus 2.0]
||ads.example.com^
@@||ads.example.com/fine/*
|https://track.
/banner/*/img^
swf|
||example.org^$script
example.com##.ad
/^https?:\\/\\/[a-z]+\\.bad\\.net\\/x/
||exämple.net/q
"""
LISTED = {
    "http://ads.example.com/x": "block", "https://www.ads.example.com:80/": "block", "http://ads.example.com": "block",
    "http://ads.example.community/": "allow", "http://badads.example.com/": "allow",
    "http://ads.example.com/fine/1": "allow", "HTTPS://TRACK.me/": "block", "http://a.b/https://track.me": "allow",
    "http://a.b/banner/x/img?1": "block", "http://a.b/banner/x/images": "allow", "http://a.b/c.swf": "block",
    "http://a.b/c.swf?x": "allow", "http://example.org/": "allow", "http://q.bad.net/xyz": "block",
    "http://q1.bad.net/xyz": "allow", "http://exämple.net/q1": "block",
}


def test_lines_of_a_filter_list(spark):
    rules = urlfilter.parse_rules(LINES.split("\n"))
    assert len(rules) == 7
    by_name = {r.name: r for r in rules}
    assert by_name["||ads.example.com^"].tokens == ("ads", "example", "com")
    assert by_name["/banner/*/img^"].tokens == ("banner", "img") and by_name["swf|"].tokens == ()
    assert by_name["|https://track."].tokens == ("https", "track")
    assert by_name["/^https?:\\/\\/[a-z]+\\.bad\\.net\\/x/"].tokens == ("bad", "net")
    urls = spark.createDataFrame([(u,) for u in LISTED], "url string")
    for most in (500, 0):
        assert {r.url: r.verdict for r in urlfilter.judge(urls, rules, max_inline=most).collect()} == LISTED


def test_a_thousand_rules_give_what_a_scan_of_all_gives(spark):
    import random
    import re

    rng = random.Random(4)
    names = ["ad", "ads", "x", "track", "shop", "é", "img", "a1"]

    def text(n):
        return "".join(rng.choice([*names, ".", "/", "-", "?", "_", "%", "="]) for _ in range(n))

    lines = set()
    while len(lines) < 1000:
        marks = rng.choice(["{}", "||{}^", "|http://{}", "{}|", "{}*{}", "^{}^", "@@{}^{}"])
        lines.add(marks.format(text(rng.randint(2, 5)), text(rng.randint(1, 3))))
    rules = urlfilter.parse_rules(sorted(lines))
    assert len(rules) > 900
    urls = [f"http://{text(rng.randint(1, 4))}.com/{text(rng.randint(0, 9))}" for _ in range(400)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    got = {r.i: r.verdict for r in urlfilter.judge(df, rules).collect()}
    for i, u in enumerate(urls):
        fits = {r.verdict for r in rules if re.search(r.pattern, u.lower())}
        assert got[i] == ("block" if fits == {"block"} else "allow"), u
