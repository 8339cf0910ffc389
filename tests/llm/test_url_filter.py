import math
from collections import Counter, defaultdict

import pytest

from cadenza.llm import url_filter as uf


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    m = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return host, path[:m]


def rule_of(host, path):
    found = None
    for rule, verdict in uf.RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (found is None or len(rule) > len(found[0])):
            found = (rule, verdict)
    return found


def plain_scores(texts, order, train):
    """Mean log ratio of each text, by the recursion over orders. ``train``: texts of each class with repeats."""
    models = {}
    for name, own in train.items():
        counts = defaultdict(Counter)
        for t in own:
            t = uf.BEGIN + t + uf.END
            for i in range(1, len(t)):
                for k in range(min(i, order) + 1):
                    counts[t[i - k : i]][t[i]] += 1
        models[name] = counts

    def p(name, context, c):
        before = p(name, context[1:], c) if context else uf.FLOOR
        own = models[name].get(context)
        return (own[c] + len(own) * before) / (sum(own.values()) + len(own)) if own else before

    out = {}
    for t in texts:
        s = uf.BEGIN + t + uf.END
        grams = [(s[max(0, i - order) : i], s[i]) for i in range(1, len(s))]
        out[t] = sum(math.log(p("allow", *g)) - math.log(p("block", *g)) for g in grams) / len(grams)
    return out


URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "://x",
    "HTTP://EXAMPLE.ORG/es/1",
    "http://example.org",
    "http://example.org?x=/y",
    "http://org/",
    "http://notorg/",
    "http://a.borg/x",
    "http://example.org/en/1",
    "http://example.org/en/12#a",
    "http://Sub.Example.org/en/2",
    "https://a.com/fr/",
    "https://a.com/FR/",
    "https://a.com/de/x?y=http://b.org/",
    "ftp://ü.net/日本\n/x",
    "http://x.net/" + "a" * 3000,
    "a://b://c.org/d",
    "http://u@h.com:80/de/",
]


def test_against_brute_force(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate(URLS)]
    rows += [(100 + i, f"http://s{i % 9}.example.{['org', 'com', 'net'][i % 3]}/{['es', 'en', 'de', 'fr'][i % 4]}/{i}", "", "") for i in range(200)]
    rows += [(5, URLS[5], "h", "p"), (None, URLS[16], "h", "p"), (7, "http://x.com/fr/", "h", "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, text string")
    got = uf.judge(df, order=3).collect()
    assert len(got) == len(rows)
    hashed = df.select(uf.host_of(uf.F.col("url")).alias("h"), uf.path_of(uf.F.col("url")).alias("p")).distinct()
    held = {r.h + r.p for r in hashed.where(uf.F.pmod(uf.F.xxhash64("h", "p"), uf.F.lit(uf.HELD)) == 0).collect()}
    train = {"allow": [], "block": []}
    for _, u, *_ in rows:
        h, p = parts(u)
        rule = rule_of(h, p)
        if rule and h + p not in held:
            train[rule[1]].append(h + p)
    want = plain_scores({"".join(parts(r[1])) for r in rows}, 3, train)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.page_id].append(r)
    for i, u, *_ in rows:
        h, p = parts(u)
        rule = rule_of(h, p)
        r = next(x for x in by_id[i] if (x.host, x.path) == (h, p))
        assert r.rule == (rule[0] if rule else None)
        assert r.score == pytest.approx(want[h + p], abs=1e-5)
        assert r.verdict == (rule[1] if rule else "allow" if r.score >= r.threshold else "block")


def test_whole_url_against_brute_force(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate([*URLS, "mail:a", "http://x.net/a?q=1", "http://x.net/a#q=1"])]
    for i in range(120):
        host, query = [("a.example.org/es/", "spam=1"), ("b.com/fr/", "page=2#top")][i % 2]
        rows.append((100 + i, f"http://{host}{i % 7}?{query}{i}", "", ""))
    rows += [(300, "http://z.net/x?spam=1", "", ""), (301, "http://z.net/x?page=2#top", "", ""), (301, "http://z.net/x?page=2#top", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, text string")
    got = uf.judge(df, order=3, whole=True).collect()
    assert sorted(r.page_id for r in got) == sorted(r[0] for r in rows)
    urls = {i: u or "" for i, u, *_ in rows}
    cut = df.select(uf.F.coalesce("url", uf.F.lit("")).alias("u")).distinct()
    held = {r.u for r in cut.where(uf.F.pmod(uf.F.xxhash64("u"), uf.F.lit(uf.HELD)) == 0).collect()}
    train = {"allow": [], "block": []}
    for _, u, *_ in rows:
        rule = rule_of(*parts(u))
        if rule and u not in held:
            train[rule[1]].append(u)
    want = plain_scores(set(urls.values()), 3, train)
    for r in got:
        rule = rule_of(*parts(urls[r.page_id]))
        assert (r.host, r.path) == parts(urls[r.page_id])
        assert r.rule == (rule and rule[0])
        assert r.score == pytest.approx(want[urls[r.page_id]], abs=1e-5)
        assert r.verdict == (rule[1] if rule else "allow" if r.score >= r.threshold else "block")
    scores = {r.page_id: r.score for r in got}
    assert scores[300] < scores[301]


def test_query_judges_more_than_host_and_path(spark, tmp_path):
    """The query itself, not only the function, tells URLs apart that differ in the query, fragment or scheme."""
    urls = ["http://z.net/x?a=1", "http://z.net/x#b", "https://z.net/x", "no scheme", "mail:a"]
    urls += [f"http://a.example.org/es/{i}?spam={i}" for i in range(40)]
    urls += [f"https://b.com/fr/{i}#top" for i in range(40)]
    rows = [(i, u, "") for i, u in enumerate(urls)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    scores = {r.page_id: r.score for r in uf.op6_url_language_ratio(spark, str(tmp_path)).collect()}
    assert len({scores[i] for i in range(5)}) == 5


def test_longest_rule_wins():
    assert rule_of("a.example.org", "/es/x") == ("example.org/es/", "block")
    assert rule_of("example.org", "") is None


def test_empty_and_unlabelled(spark):
    schema = "page_id long, url string"
    assert uf.judge(spark.createDataFrame([], schema)).collect() == []
    (r,) = uf.judge(spark.createDataFrame([(1, "http://a.net/x")], schema)).collect()
    assert (r.rule, r.verdict, r.threshold, r.score) == (None, "allow", 0.0, 0.0)


def test_query(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    got = uf.op6_url_language_ratio(spark, sf_dir).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        rule = rule_of(*parts(pages[r.page_id]))
        assert (r.host, r.path) == parts(pages[r.page_id])
        assert r.rule == (rule and rule[0])
        assert r.verdict in ("allow", "block") and (not rule or r.verdict == rule[1])
