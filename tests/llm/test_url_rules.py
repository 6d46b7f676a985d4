"""URL rules against trying every rule on every URL."""

import random
import re

from ingot.llm import url_rules as U
from ingot.llm.queries import SITE_RULES

RULES = (*SITE_RULES, *U.WORD_RULES)


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.split("[/?#]", rest)[0])
        path = re.split("[?#]", rest[len(host) :])[0]
    fit = []
    for r in rules:
        if r.site:
            h, _, p = r.name.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fit.append(r)
    if fit:
        best = max(fit, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    words = [w for w in re.split(r"[./_\-]+", (host + path).translate(U._TO_LOWER))]
    bad = any(words[i : i + len(r.tokens)] == list(r.tokens) for r in rules if not r.site for i in range(len(words)))
    return host, path, None, "block" if bad else "allow"


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x=://y", "https://example.org/en/123#t", "https://example.org/en/2", "https://badexample.org/es/", "http://org", "http://org/",
        "http://a.com/fr/x", "http://a.com/fr", "http://a.com/DE/", "http://a.com/de/", "http://a.com?x/de/", "http://spam-farm.example.net/q", "http://x.net/cheap-pills", "http://x.net/cheap/y/pills",
        "http://x.net/spammy", "a://b://c.com/de/1", "http://exam\nple.org/\nes/", "http://é.com/de/É", "http://x.example.org:80/es/", "http://x.net/" + "a-" * 50_000 + "casino"]


def test_equals_trying_every_rule(spark):
    r = random.Random(2)
    urls = URLS + ["http://" + ".".join(r.choice(("org", "com", "example", "a", "spam")) for _ in range(r.randrange(1, 4))) + "".join("/" + r.choice(("es", "en", "fr", "de", "1", "12", "", "xxx")) for _ in range(r.randrange(4))) for _ in range(500)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, None, "x"), (None, "http://a.com/de/", "y")], "page_id long, url string, host string")
    got = U.judge(pages, RULES).collect()
    assert len(got) == len(urls) + 2
    for row in got:
        url = "http://a.com/de/" if row["page_id"] is None else urls[row["page_id"]]
        assert tuple(row)[1:] == brute(url, RULES), url


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://example.org/{'es' if i < 2 else 'en'}/{i}") for i in range(9)], "page_id long, url string")
    counts = U.token_counts(pages, SITE_RULES)
    assert counts == {"example": 9, "org": 9, "es": 2, "en": 7}
    index = U.index_rules(SITE_RULES, counts)
    assert [r.name for r in index["es"]] == ["example.org/es/"] and [r.name for r in index["en"]] == ["example.org/en/1"]


def test_rule_without_tokens_and_empty_table(spark):
    rules = [U.Rule("any", "block", ".*", (), site=False)]
    pages = spark.createDataFrame([(1, "http://x.y/")], "page_id long, url string")
    assert U.judge(pages, rules).first()["verdict"] == "block"
    assert U.judge(pages.limit(0), RULES).count() == 0


def test_very_many_rules(spark):
    """A hundred thousand rules are filed and met without being compiled."""
    import time

    rules = [U.word_rule("block", f"word{i}", "x") for i in range(100_000)]
    pages = spark.createDataFrame([(i, f"http://a.org/word{i * 400}/{'x' if i % 2 else 'y'}") for i in range(250)], "page_id long, url string")
    began = time.time()
    got = {r["page_id"]: r["verdict"] for r in U.judge(pages, rules).collect()}
    assert got == {i: "block" if i % 2 else "allow" for i in range(250)} and time.time() - began < 60
