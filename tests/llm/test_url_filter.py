import pytest
from pyspark.sql import functions as F

from velometry.llm import url_filter as u
from velometry.llm.queries import RULES


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [
        (None, "", ""),
        ("", "", ""),
        ("no scheme/path", "", ""),
        ("HTTP://A.Ü.Com/X/Y?q#f", "a.Ü.com".replace("Ü", "Ü"), "/X/Y"),
        ("http://a.com", "a.com", ""),
        ("http://a.com?x=/y", "a.com", ""),
        ("http://a.com#x/y?z", "a.com", ""),
        ("http://a.com/p#x?y", "a.com", "/p"),
        ("x://http://b/c", "http:", "//b/c"),
        ("://", "", ""),
    ],
)
def test_split(url, host, path):
    assert u.split_url(url) == (host, path)


@pytest.mark.parametrize(
    ("host", "path", "name"),
    [
        ("a.com", "/x", "com/"),
        ("com", "/x", "com/"),
        ("a.com", "", None),
        ("acom", "/", None),
        ("example.com", "/en/1", "example.com/en/"),
        ("b.example.com", "/en/1", "example.com/en/"),
        ("www.example.com", "/en/1", "www.example.com/en/"),
        ("x.www.example.com", "/en/1", "www.example.com/en/"),
        ("example.com", "/fr/1", "com/"),
        ("a.net", "/es/", "net/es/"),
        ("a.net", "/es", None),
        ("", "/es/", None),
        ("xwww.example.com", "/en/1", "example.com/en/"),
        ("a." * 300_000 + "net", "/fr/", "net/fr/"),
    ],
)
def test_longest_rule(host, path, name):
    by_host = {}
    for r in RULES:
        by_host.setdefault(r.host, []).append(r)
    found = u.matching_rule(host, path, by_host, len("www.example.com"))
    assert (found and found.name) == name


@pytest.mark.parametrize(
    ("url", "strict", "soft"),
    [
        ("http://casino.org/", 1, 0),
        ("http://casinos.org/", 0, 0),
        ("http://x-casino-casino.org/", 2, 0),
        ("http://free-bets.org/free", 0, 2),
        ("http://a.org/?utm_source=feed", 0, 0),
        ("http://FREE.org/Win", 0, 2),
        ("http://freewin.org/", 0, 0),
        ("http://éfree.org/", 0, 1),
        ("bet" * 100_000, 0, 0),
        ("", 0, 0),
    ],
)
def test_terms(url, strict, soft):
    assert u.count_terms(url, u.UrlVocabulary()) == (strict, soft)


def test_empty_vocabulary():
    assert u.count_terms("casino", u.UrlVocabulary((), ())) == (0, 0)


def test_rows(spark):
    rows = [(1, "http://free-bets.org/"), (1, "http://free-bets.org/"), (None, None), (2, "http://a.net/es/x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("rule", F.lit(1))
    got = sorted(
        ((r.page_id, r.host, r.rule, r.verdict) for r in u.judge_urls(df, RULES).collect()), key=str
    )
    assert got == [
        (1, "free-bets.org", None, "block"),
        (1, "free-bets.org", None, "block"),
        (2, "a.net", "net/es/", "block"),
        (None, "", None, "allow"),
    ]
    assert u.judge_urls(df.limit(0), RULES).count() == 0


@pytest.mark.parametrize(
    ("url", "verdict"),
    [
        ("http://casinos-online.com", "block"),
        ("http://a.org/gambling/slots", "block"),
        ("http://porno.example.org/", "block"),
        ("http://freebets.com", "block"),
        ("http://gluecksspiel.example.org/x", "block"),
        ("http://a.org/loteria-gratis", "block"),
        ("http://a.org/gambling-law", "allow"),
        ("http://essex.ac.uk/young-adults/", "allow"),
        ("http://a.org/paris/musee-gratuit", "allow"),
        ("http://a.org/kredit/zinsen", "allow"),
    ],
)
def test_wide_vocabulary(spark, url, verdict):
    df = spark.createDataFrame([(1, url)], "page_id bigint, url string")
    assert u.judge_urls(df, (), u.wide_vocabulary()).first().verdict == verdict


def test_wide_vocabulary_holds_the_default_one():
    wide, base = u.wide_vocabulary(), u.UrlVocabulary()
    assert set(base.strict) <= set(wide.strict) and set(base.soft) <= set(wide.soft)
    assert not set(wide.strict) & set(wide.soft)
    assert all(t == t.lower() and t.isascii() for t in wide.strict + wide.soft)
