"""Public suffixes, archives and chains of links."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from factloom.functions import suffixes, urls
from factloom.operators import links

listed = pytest.mark.skipif(suffixes.list_path() is None, reason="no public suffix list on this machine")
RULES = ["com", "jp", "kyoto.jp", "*.kobe.jp", "!city.kobe.jp", "uk", "co.uk", "nhs.uk", "*.ck", "!www.ck", "p.com", "公司.cn", "cn"]


def domains(spark, hosts, **how):
    rows = spark.createDataFrame([(i, f"https://{h}/x?y=http://z.org") for i, h in enumerate(hosts)], "i long, url string")
    return [r.d for r in rows.select("i", urls.registered_domain(F.col("url"), **how).alias("d")).orderBy("i").collect()]


def by_labels(host, rules):
    """The published algorithm: the longest rule that matches, an exception first."""
    labels = host.split(".")
    best = 0
    for rule in rules:
        parts = rule.lstrip("!").split(".")
        if len(parts) <= len(labels) and all(a in ("*", b) for a, b in zip(parts[::-1], labels[::-1], strict=False)):
            if rule.startswith("!"):
                best = len(parts) - 1
                break
            best = max(best, len(parts))
    out = ".".join(labels[-best - 1 :]) if 0 < best < len(labels) else ""
    return out.removeprefix("www.")


def test_given_rules(spark):
    cases = {"a.b.kyoto.jp": "b.kyoto.jp", "kyoto.jp": "", "x.y.kobe.jp": "x.y.kobe.jp", "y.kobe.jp": "", "city.kobe.jp": "city.kobe.jp", "a.city.kobe.jp": "city.kobe.jp", "lg.x.nhs.uk": "x.nhs.uk", "a.b.ck": "a.b.ck", "b.ck": "", "www.ck": "ck", "x.www.ck": "ck", "a.p.com": "a.p.com", "p.com": "", "b.a.q.com": "q.com", "www.q.com": "q.com", "a.xn--55qx5d.cn": "a.xn--55qx5d.cn", "a.公司.cn": "a.公司.cn", "unknown.tld": "", "com": ""}
    assert domains(spark, cases, rules=RULES) == list(cases.values())


def test_random_hosts_against_the_algorithm(spark):
    r = random.Random(3)
    labels = ["a", "b", "www", "city", *{x for rule in RULES for x in rule.strip("!*.").split(".")}]
    hosts = [".".join(r.choice(labels) for _ in range(r.randint(1, 5))) for _ in range(600)]
    assert domains(spark, hosts, rules=RULES) == [by_labels(h, RULES) for h in hosts]


@listed
def test_whole_list_against_the_algorithm(spark):
    with open(suffixes.list_path(), encoding="utf-8") as f:
        text = f.read()
    for private in (False, True):
        rules = suffixes.read_rules(text, private)
        r = random.Random(7)
        some = r.sample([x for x in rules if x.isascii()], 250) + [x for x in rules if x.isascii() and x[0] in "!*"][:40]
        hosts = [r.choice(["", "www.", "a.", "a.b."]) + rule.lstrip("!").replace("*", "w") for rule in some]
        by_end = {}
        for rule in rules:
            by_end.setdefault(rule.split(".")[-1], []).append(rule)
        assert domains(spark, hosts, private=private) == [by_labels(h, by_end.get(h.split(".")[-1], [])) for h in hosts]


@listed
def test_named_cases(spark):
    cases = {"foo.blogspot.com": "blogspot.com", "a.b.kyoto.jp": "b.kyoto.jp", "x.k12.ca.us": "x.k12.ca.us", "lg.x.nhs.uk": "x.nhs.uk", "a.b.ck": "a.b.ck", "www.ck": "ck", "www.bbc.co.uk": "bbc.co.uk", "10.0.0.1": "", "localhost": "", "A.Example.GOV.br.": "example.gov.br"}
    assert domains(spark, cases) == list(cases.values())
    assert domains(spark, ["foo.blogspot.com", "www.blogspot.com", "blogspot.com", "x.github.io"], private=True) == ["foo.blogspot.com", "blogspot.com", "", "x.github.io"]


def test_links_of_all_shapes(spark):
    cases = {"https://u:p@a.b.co.uk:8080/x": "b.co.uk", "//b.co.uk/x": "b.co.uk", "b.co.uk/x?y": "b.co.uk", "HTTP://B.Co.Uk#x": "b.co.uk", "": "", "http://": "", "mailto:me@b.co.uk": "b.co.uk"}
    rows = spark.createDataFrame([(i, u) for i, u in enumerate([*cases, None])], "i long, url string")
    got = [r.d for r in rows.select("i", urls.registered_domain(F.col("url"), rules=RULES).alias("d")).orderBy("i").collect()]
    assert got == [*cases.values(), ""]


def test_archives(spark):
    cases = {
        "https://web.archive.org/web/2022/https:/x.com/p": "https://x.com/p",
        "http://web.archive.org/web/1/http://web.archive.org/web/2/http:/y.org/a?b": "http://y.org/a?b",
        "https://web.archive.org/save/http:/z.org": "http://z.org",
        "https://web.archive.org/web/2022/foo/bar": None,
        "https://archive.org/web/2022/https://x.com/p": None,
        "https://archive.org/details/x": None,
    }
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "i long, url string")
    got = [r.u for r in rows.select("i", urls.unwrapped(F.col("url")).alias("u")).orderBy("i").collect()]
    assert got == [want or url for url, want in cases.items()]
    pages = ["<form action='https://archive.is/search/' id=x><p><input name=q value='http://a.org/?x=1&amp;y=2'></form>", '<FORM id="s" action="https://archive.is/search/"><input VALUE="http://b.org" type=text></form>', '<form action="https://archive.ph/search/"><input value="http://c.org"></form>', "<input value='http://d.org'>", None]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i long, html string")
    got = [r.u for r in rows.select("i", urls.form_target(F.col("html"), F.lit("archive.is")).alias("u")).orderBy("i").collect()]
    assert got == ["http://a.org/?x=1&y=2", "http://b.org", None, None, None]


def test_chains(spark):
    """Chains of all lengths, cycles and links that lead into them, archives of archives, several targets, nulls."""
    n = 40
    hops = [(f"http://c.org/{i}", f"http://c.org/{i + 1}") for i in range(n)] + [("http://r.org/a", "http://r.org/b"), ("http://r.org/b", "http://r.org/c"), ("http://r.org/c", "http://r.org/a"), ("http://into.org/1", "http://r.org/b")]
    hops += [("http://self.org/x", "http://self.org/x"), ("http://two.org/x", "http://b.org/2"), ("http://two.org/x", "http://b.org/1"), (None, "http://n.org"), ("http://n.org/1", None), ("http://t.org/1", "https://web.archive.org/web/1/http://archive.is/abc"), ("http://m.org/1", "http://end.org/?b=1&a=2")]
    pages = [("http://archive.is/abc", '<form action="https://archive.is/search/"><input value="http://c.org/38"></form>'), ("https://archive.is/none", "<p>nothing</p>")]
    cases = {f"http://c.org/{i}": f"http://c.org/{n}" for i in range(n + 1)}
    cases |= {"http://r.org/a": "http://r.org/a", "http://into.org/1": "http://into.org/1", "http://self.org/x": "http://self.org/x", "http://two.org/x": "http://b.org/1", "http://n.org/1": "http://n.org/1", "http://t.org/1": "http://c.org/40", "http://m.org/1/": "http://end.org/?b=1&a=2"}
    cases |= {"https://archive.is/none": "https://archive.is/none", "https://perma.cc/none": "https://perma.cc/none", "Plain.org/x/": "https://plain.org/x", "ftp://no.org": None, None: None, "https://web.archive.org/web/1/https://web.archive.org/web/2/http://c.org/39": "http://c.org/40"}
    asked = spark.createDataFrame([(i, u, "k") for i, u in enumerate([*cases, "http://c.org/3"])], "i long, url string, key string")
    out = links.resolved_links(asked, spark.createDataFrame(hops, "url string, to string"), spark.createDataFrame(pages, "url string, html string"))
    assert out.columns == asked.columns
    assert [r.url for r in out.orderBy("i").collect()] == [*cases.values(), "http://c.org/40"]
    none = links.resolved_links(asked.limit(0), spark.createDataFrame([], "url string, to string"), spark.createDataFrame([], "url string, html string"))
    assert none.count() == 0


def test_without_a_list(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "list_path", lambda: None)
    assert domains(spark, ["www.a.co.uk", "a.gov.br", "x.a.org", "gov.br", "x.y.qc.ca"]) == ["a.co.uk", "a.gov.br", "a.org", "", "y.qc.ca"]
