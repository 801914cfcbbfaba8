import re

from hypothesis import given, settings, strategies as st

from agrospark.llm import url_filter as U
from tests.llm.brute import lower


def pattern(glob):
    out = ""
    for p in re.findall(r"\[[^\]]+\]|\*+|.", glob, re.S):
        out += "[" + re.escape(p[1:-1]) + "]" if p[0] == "[" and len(p) > 1 else {"*": "[^/]*", "?": "[^/]"}.get(p) or (
            ".*" if p[0] == "*" else re.escape(p))
    return re.compile(out, re.S)


def plain(url, rules=U.RULES, globs=U.GLOBS):
    rest = (url or "").partition("://")[2]
    rest = re.match(r"[^?#]*", rest)[0]
    host, slash, path = rest.partition("/")
    host, path = lower(host), slash + path
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    glob = next((g for g in globs if pattern(g).fullmatch("." + host + path)), None)
    verdict = best.verdict if best else "block" if glob else "allow"
    return host, path, best and best.name, verdict, glob


URLS = [
    None, "", "no scheme", "http://", "://", "http://ORG", "http://ORG/", "https://a.org/x", "http://evil.net/a.org/es/", "http://example.org/es/1",
    "http://x.example.org/es/", "http://badexample.org/es/", "http://example.org/es", "http://example.org/en/1", "http://example.org/en/123", "http://example.org/en/2",
    "http://a.com/fr/", "http://a.com/de/x?q=/fr/", "http://a.com?x=/fr/", "http://a.com#/fr/", "http://a.com/FR/", "https://www.spam-farm.example.net/x",
    "https://spamalot.net/", "https://a.net/spam-x/", "ftp://a://b.org/", "http://ads.net", "http://é.org/ü?x", "http://casino-win.example.com/fr/1",
    "http://a\n.net/\nx.exe", "http://.org/", "http://user@ads.x:80/", "http://long.net/" + "a/" * 60_000 + "x.exe", "http://" + "b" * 50_000 + ".com/de/", "http://x.net/wp-login.php",
]
SCHEMA = "page_id bigint, url string, html string, host string, rest string, rule string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "a", "b", "c") for i, u in rows], SCHEMA)


def test_verdicts_equal_a_plain_reading(spark):
    rows = list(enumerate(URLS)) + [(None, "http://a.org/"), (7, "http://a.org/"), (7, "http://a.org/")]
    got = U.judge(pages(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *plain(u)) for i, u in rows), key=str)
    by = {r.page_id: r.verdict for r in got}
    assert by[URLS.index("https://www.spam-farm.example.net/x")] == "block" and by[URLS.index("https://spamalot.net/")] == "allow"


def test_empty_table_and_no_rules(spark):
    assert U.judge(pages(spark, [])).count() == 0
    assert [r.verdict for r in U.judge(pages(spark, [(1, "http://spam.net/")]), rules=(), globs=()).collect()] == ["allow"]


def test_equally_long_rules_take_the_first(spark):
    rules = (U.Rule("block", "a.com", "/"), U.Rule("allow", "a.com", "/"), U.Rule("allow", "com", "/[*]"))
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge(pages(spark, [(1, "x://a.com/"), (2, "x://b.com/[*]y")]), rules, ()).collect()}
    assert got == {1: ("a.com/", "block"), 2: ("com/[*]", "allow")}


letters = st.text(alphabet="ab/.é-", max_size=12)
globs = st.lists(st.lists(st.sampled_from(["a", "b", "/", ".", "é", "*", "**", "?", "[ab]", "[-.]"]), max_size=8).map("".join), min_size=1, max_size=30)


@settings(max_examples=300, deadline=None)
@given(globs, st.lists(letters, max_size=20), st.integers(0, 20))
def test_automaton_equals_regular_expressions(some, texts, few):
    fits = U.Automaton(some).fits(texts, few)
    assert fits.shape == (len(texts), len(some))
    for t, row in zip(texts, fits):
        assert row.tolist() == [bool(pattern(g).fullmatch(t)) for g in some]
