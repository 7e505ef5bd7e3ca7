import random

import pytest

from tidemark.llm import urls

PAGES = "page_id long, url string, html string, host string, rule string"


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def brute(url, rules):
    host, path = split_url(url)
    fits = [
        (len(h + p), len(h), v, h + p)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, _, verdict, rule = max(fits, default=(0, 0, "allow", None))
    return host, path, rule, verdict


@pytest.mark.parametrize("block_rules", [2, 1000])
def test_rules_match_brute_force(spark, block_rules):
    rng = random.Random(4)
    labels, paths = ["com", "net", "a", "b", "www", "é", "a-b"], ["/", "/x", "/x/", "/x/y", "/é"]
    rules = list({
        (rng.choice(["allow", "block"]), ".".join(rng.choice(labels) for _ in range(rng.randint(1, 3))), rng.choice(paths))
        for _ in range(40)
    })
    given = [None, "", "no scheme", "http://", "https://COM", "x://a.com?/x", "http://a.com#/x", "http://.com/x", "http://a.com./x"]
    for _ in range(400):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 5)))
        given.append(f"http://{host}" + rng.choice(["", "/", "/x", "/x/y/z?q=/", "/é#f", "?/x", "/y"]))
    pages = spark.createDataFrame([(i, u, "h", "clash", "clash") for i, u in enumerate(given + given[:20])], PAGES)
    rows = urls.judge_urls(pages.repartition(7), rules, block_rules=block_rules).collect()
    assert len(rows) == len(given) + 20
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute((given + given[:20])[r["page_id"]], rules)


def test_empty_tables_and_no_rules(spark):
    pages = spark.createDataFrame([(None, "http://a.com/", None, None, None)], PAGES)
    row = urls.judge_urls(pages, []).first()
    assert (row["page_id"], row["host"], row["rule"], row["verdict"]) == (None, "a.com", None, "allow")
    assert urls.judge_urls(pages.limit(0), [("block", "com", "/")]).count() == 0
