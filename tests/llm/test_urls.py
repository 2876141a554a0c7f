import itertools
import random

from pyspark.sql import functions as F

from roadflow.llm import urls
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]


def ruled(host, path):
    best = None
    for verdict, own, prefix in urls.RULES:
        if (host == own or host.endswith("." + own)) and path.startswith(prefix) and (best is None or len(own + prefix) > len(best[0])):
            best = (own + prefix, verdict)
    return best


CASES = ["https://WWW.Example.com/en/x?q=1#t", "http://example.com/en/", "http://notexample.com/en/a", "x://a.net/es/1", "x://net/fr/", "http://com", "http://com/", "http://a.com?x=/en/", "http://b.com#/", "nothing", "", None, "a://b://c/d", "http://[::1]:80/fr/\nz", "http://é.net/es/ü"]


def test_given_and_odd_urls(spark):
    known = [r.url for r in spark.read.parquet(f"{D}/pages.parquet").select("url").collect()]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(known + CASES)], "page_id long, url string")
    rule = urls.fitting_rule(F.col("host"), F.col("path"), urls.RULES)
    rows = df.withColumns({"host": urls.host_of(F.col("url")), "path": urls.path_of(F.col("url"))}).withColumn("fit", rule).collect()
    for r in rows:
        host, path = split(r.url)
        assert (r.host, r.path, tuple(r.fit) if r.fit else None) == (host, path, ruled(host, path)), r.url


def test_query_keeps_every_page(spark):
    rows = QUERIES["op8_url_filters"](spark, D).collect()
    assert len(rows) == 50
    for r in rows:
        if want := ruled(r.host, r.path):
            assert (r.rule, r.verdict) == want
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def fixture(spark):
    rows, labels = [], []
    for i in range(60):
        bad = i % 3 == 0
        rows.append((i, f"https://h{i % 7}.example.org/{'casino/win' if bad else 'casino/news' if i % 3 == 1 else 'garden/win'}/{i}"))
        labels.append((i, 1, int(bad)))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    return pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_mined_combination_and_pruning(shipped):
    pages, labels = fixture(shipped)
    mined = urls.mine_rules(pages, labels, min_support=0.05, min_confidence=0.9)
    assert [sorted(r.tokens) for r in mined.collect()] == [["p:casino", "p:win"]]
    new = shipped.createDataFrame([(1, "http://n.org/win/casino/9"), (2, "http://n.org/casino"), (3, None), (4, "http://n.org/win/casino/9"), (5, "")], "page_id long, url string")
    new = new.selectExpr("*", "'mine' as confidence", "1 as tokens", "2 as key", "3 as _fit", "4 as held", "5 as alike")
    got = {r.page_id: (r.verdict, r.rule) for r in urls.judge_urls(new, (), mined).collect()}
    assert got == {1: ("block", None), 2: ("allow", None), 3: ("allow", None), 4: ("block", None), 5: ("allow", None)}
    assert {r._fit for r in urls.judge_urls(new, (), mined).collect()} == {3}
    assert urls.judge_urls(new.limit(0), (), mined).count() == 0


def brute(baskets, least, min_confidence, min_lift):
    """Rules by trying every combination of tokens on bad pages; a rule is kept unless a part of it says as much."""
    rate = sum(b for _, b in baskets) / len(baskets)
    count = lambda s, bad=None: sum(s <= t and (bad is None or b == bad) for t, b in baskets)
    sets = {frozenset(c) for t, b in baskets if b for n in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), n)}
    found = {s: count(s, 1) / count(s) for s in sets if count(s, 1) >= least}
    found = {s: c for s, c in found.items() if c >= min_confidence and c >= min_lift * rate}
    return {s: c for s, c in found.items() if not any(o < s and found[o] >= c for o in found)}


def test_mined_rules_equal_brute_force(shipped):
    rnd = random.Random(9)
    words = ["casino", "win", "garden", "news", "play", "shop"]
    urls_ = [f"http://x{rnd.choice('abc')}.org/" + "/".join(sorted(rnd.sample(words, rnd.randrange(1, 5)))) for _ in range(160)]
    labels = [int(("casino" in u and "win" in u) or ("play" in u and rnd.random() < 0.8)) for u in urls_]
    pages = shipped.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    marked = shipped.createDataFrame([(i, 1, b) for i, b in enumerate(labels)], "doc_id long, quality int, toxic int")
    tokens = {r.page_id: frozenset(r.t) for r in pages.select("page_id", urls.url_tokens(F.col("url")).alias("t")).collect()}
    want = brute([(tokens[i], labels[i]) for i in range(160)], 5, 0.7, 1.5)
    mined = urls.mine_rules(pages, marked, min_support=0.002, min_confidence=0.7).collect()
    # Each choice of one token alike is a rule of the brute-force version.
    got = {frozenset(c): r.confidence for r in mined for c in itertools.product(*r.alike)}
    assert len(want) > 3 and got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-12 for s in want)
    judged = {r.page_id: r.verdict for r in urls.judge_urls(pages, (), urls.mine_rules(pages, marked)).collect()}
    assert judged == {i: "block" if any(s <= t for s in want) else "allow" for i, t in tokens.items()}


def test_long_urls_that_repeat_do_not_explode(shipped):
    """Ten bad pages share a URL of forty words among a thousand others."""
    long = "http://bad.org/" + "/".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40))
    rows = [(i, long if i < 10 else f"http://h{i % 5}.org/a{chr(97 + i % 26)}/{i}") for i in range(1010)]
    pages = shipped.createDataFrame(rows, "page_id long, url string")
    labels = shipped.createDataFrame([(i, 1, int(i < 10)) for i, _ in rows], "doc_id long, quality int, toxic int")
    mined = urls.mine_rules(pages, labels).collect()
    assert {len(r.tokens) for r in mined} == {1} and len(mined[0].alike[0]) >= 41 and {r.confidence for r in mined} == {1.0}
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages, (), urls.mine_rules(pages, labels)).collect()}
    assert {i for i, v in got.items() if v == "block"} == set(range(10))


def test_without_labels(shipped):
    pages, labels = fixture(shipped)
    assert urls.mine_rules(pages, labels.limit(0)).count() == 0
    nulls = labels.selectExpr("doc_id", "cast(null as int) quality", "cast(null as int) toxic")
    assert urls.mine_rules(pages, nulls).count() == 0
