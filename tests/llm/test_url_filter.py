import re
import zlib
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import Rule, grams, judge_urls, labelled_names, labelled_table, labelled_urls, train

URLS = [
    None, "", "no scheme.example.net/en/", "http://a.example.net/en/1", "http://example.net/de/", "https://EXAMPLE.com/de/x?q#f",
    "http://xexample.com/de/", "http://a.b.org/fr/", "http://a.org/FR/", "http://b.net", "http://b.net?x=/en/",
    "http://casino-win.example.com/en/1", "http://library.example.org/en/1", "ftp://x://y.net/z", "http://É.net/a#b?c",
    "http://a.example.net/en/1", "http://" + "a." * 3000 + "net/" + "p" * 20000,
]


def plain(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return host, path, max(fits, key=lambda r: len(r.host + r.path), default=None)


def test_rules_and_model(spark):
    model = train(labelled_table(spark))
    pages = spark.createDataFrame([(i, u, "r", "h") for i, u in enumerate(URLS)], "page_id long, url string, rule string, host string")
    rows = {r["page_id"]: r for r in judge_urls(pages, URL_RULES, model).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule = plain(url)
        assert (rows[i]["host"], rows[i]["path"]) == (host, path)
        assert rows[i]["rule"] == (rule.host + rule.path if rule else None)
        if rule:
            assert rows[i]["verdict"] == rule.verdict
        else:
            assert rows[i]["verdict"] == ("block" if rows[i]["score"] >= 0.5 else "allow")
    assert rows[11]["verdict"] == "block" and rows[12]["verdict"] == "allow"


def verdicts(spark, model, names):
    pages = spark.createDataFrame([(i, f"https://www.{name}.example.com/en/{i}") for i, name in enumerate(names)], "page_id long, url string")
    return {names[r["page_id"]]: r["verdict"] for r in judge_urls(pages, [], model).collect()}


def test_names_kept_out_of_training(spark):
    """A quarter of the names is kept out: most unwanted ones are blocked, few ordinary ones."""
    names = labelled_names()
    out = [(n, label) for n, label in names if zlib.crc32(n.encode()) % 4 == 0]
    model = train(labelled_table(spark, [x for x in names if x not in out]))
    found = verdicts(spark, model, [n for n, _ in out])
    unwanted, ordinary = ([n for n, label in out if label == which] for which in (1, 0))
    assert len(unwanted) > 60 and len(ordinary) > 100
    recall = sum(found[n] == "block" for n in unwanted) / len(unwanted)
    wrong = sum(found[n] == "block" for n in ordinary) / len(ordinary)
    assert recall >= 0.9 and wrong <= 0.05, (recall, wrong)


def test_names_of_other_sources(spark):
    """Names written by hand for this test, none of them in the table."""
    model = train(labelled_table(spark))
    unwanted = "freebets casino.games play-poker adult-x spam-farm cheap-pills ads-track casino-win free-bets pornhouse sexcams nudepics lottery-win".split()
    ordinary = "thither tionble therand ththre onering erthe inthand hathon openlibrary weatherman newsroom gardeners schools cookbook citymuseum".split()
    known = {n for n, _ in labelled_names()}
    assert not known.intersection(unwanted + ordinary)
    found = verdicts(spark, model, unwanted + ordinary)
    assert [n for n in unwanted if found[n] != "block"] == []
    assert [n for n in ordinary if found[n] != "allow"] == []


def test_grams_are_those_of_the_text(spark):
    row = spark.createDataFrame([("ab.c",), ("",)], "t string").select("t", grams(F.col("t"), "h:", (3, 4))).collect()
    assert row[0][1] == ["h:^ab", "h:ab.", "h:b.c", "h:.c$", "h:^ab.", "h:ab.c", "h:b.c$"] and row[1][1] == []


def test_labels_are_not_told_by_site_or_path():
    by_label = [{urlsplit(url).path for url, label in labelled_urls(labelled_names()) if label == which} for which in (0, 1)]
    assert by_label[0] == by_label[1]


def test_empty_table_and_ties(spark):
    model = train(labelled_table(spark))
    pages = spark.createDataFrame([(None, "http://thonand.example.org/es/12")], "page_id long, url string")
    assert judge_urls(pages.limit(0), URL_RULES, model).count() == 0
    # Ties between rules go to the one listed first.
    two = [Rule("allow", "org", "/"), Rule("block", "org", "/")]
    assert {r["verdict"] for r in judge_urls(pages, two, model).collect()} == {"allow"}
