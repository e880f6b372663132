"""URL verdicts against a plain scan of all rules."""

import random

from tickforge.llm import url_filter as U


def slow(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(r.host.count(".") + 1, len(r.path), r.verdict == "block", r.host + r.path, r.verdict) for r in rules
           if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_both_forms_equal_a_plain_scan(spark):
    rnd = random.Random(2)
    labels, segs = ["a", "b", "net", "org", "x-y", ""], ["", "en", "e", "de", "enx"]
    host = lambda: ".".join(rnd.choice(labels[:5]) for _ in range(rnd.randint(1, 4)))
    path = lambda: "/" + "/".join(rnd.choice(segs) for _ in range(rnd.randint(0, 3)))
    rules = [U.Rule(host(), rnd.choice([path(), "", "/", "/en"]), rnd.choice(["allow", "block"])) for _ in range(40)]
    urls = [f"{rnd.choice(['http', 'HTTPS'])}://{host().upper() if rnd.random() < .2 else host()}{rnd.choice(['', path(), path() + '?q=/en/', path() + '#/x'])}" for _ in range(400)]
    urls += [None, "", "nothing", "://", "http://", "http://net", "http://net?x=1", "a://b://net/en/", "http://é.NET/ü\n/en/", "http://net:80/", "http://a.net./", "x" * 5000 + "://net/" + "y/" * 3000]
    rows = [(i, u, "r", "v") for i, u in enumerate(urls)] + [(0, urls[0], "r", "v"), (None, urls[1], None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string")
    want = sorted(((r[0], *slow(r[1], rules)) for r in rows), key=str)
    for most in (U.MAX_TRIE_RULES, 3):
        got = U.judge(df, rules, max_trie_rules=most)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(df, [U.Rule("net", "/", "block")]).count() == 0
    some = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert U.judge(some, []).collect()[0].verdict == "allow"


def test_rules_in_blocks_and_long_urls(spark):
    rnd = random.Random(5)
    rules = [U.Rule(f"h{rnd.randrange(30)}.net", f"/{rnd.choice('abc') * rnd.randint(0, 6)}{rnd.choice(['', '/', '/x'])}", rnd.choice(["allow", "block"])) for _ in range(600)]
    rules += [U.Rule("H1.net", "/same", "allow"), U.Rule("h1.NET", "/same", "block"), U.Rule("deep.net", "/" * 5000, "block"), U.Rule("long.net", "/" + "z" * 6000, "allow")]
    urls = [f"http://{rnd.choice(['', 'w.'])}h{rnd.randrange(32)}.net/{rnd.choice('abc') * rnd.randint(0, 7)}{rnd.choice(['', '/', '/xy'])}" for _ in range(600)]
    urls += ["http://h1.net/same", "http://deep.net" + "/" * 100_000, "http://long.net/" + "z" * 50_000, "http://" + "a." * 20_000 + "h1.net/a"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    table = spark.createDataFrame([*rules, U.Rule(None, "/", "block"), U.Rule("net", None, "block")], U.RULE_SCHEMA)
    want = [(i, *slow(u, [r._replace(host=r.host.lower()) for r in rules])) for i, u in enumerate(urls)]
    for most in (U.MAX_TRIE_BYTES, 400_000):
        got = U.judge(df, table, max_trie_bytes=most)
        assert sorted(map(tuple, got.collect())) == want


def test_many_rules_of_one_folder():
    trie = U.Trie([U.Rule("net", f"/p{i}", "block") for i in range(100_000)])
    got = [trie.match("a.net", f"/p{i}x") for i in range(0, 100_000, 10)]
    assert [g[2] for g in got] == [f"net/p{i}" for i in range(0, 100_000, 10)]
    assert trie.match("net", "/q") == U.NO_RULE
