import random
import re

from hexaccess.llm import urls
from fixtures import with_clash

PAGES = "page_id long, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()


def own(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def key(url):
    whole = url.split("#")[0]
    return whole.split("://", 1)[0] + "://" + split(url)[0] + re.sub(r"^.*?://[^/?#]*", "", whole, count=1, flags=re.S)


def brute(rows, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        root[find(key(u))] = find(key(v))
    members = {}
    for n in list(root):
        members.setdefault(find(n), []).append(own(*split(n))[1])
    out = {}
    for i, url in rows:
        host, path = split(url)
        rule, verdict = own(host, path)
        if verdict is None:
            near = members.get(find(key(url)), []) if host and key(url) in root else []
            verdict = "allow" if "allow" in near or "block" not in near else "block"
        out[i] = (host, path, rule, verdict)
    return out


def test_classes_and_rules(spark):
    rng = random.Random(1)
    hosts = ["a.example.com", "b.example.com", "x.net", "Y.Example.NET", "www.example.org", "c.example.org", "net", "example.net", "evilnet"]
    all_urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/1', '/de/2', '/fr/x', '?q', '/en', '/en/a#top'])}" for _ in range(70)]
    rows, edges = [], []
    for i, url in enumerate(all_urls):
        html = "<html><head>"
        if rng.random() < 0.35:
            to = rng.choice(all_urls)
            edges.append((url, to))
            html += rng.choice([f'<link rel="canonical" href="{to}">', f"<LINK href='{to}' data-x=1 rel=canonical />",
                                f'<meta http-equiv="refresh" content="0; url={to}">'])
        rows.append((i, url, html + '<link rel="stylesheet" href="http://x.net/a.css"></head>'))
    rows += [(100, None, None), (101, "no scheme", "<p>"), (102, "", ""), (103, rows[0][1], rows[0][2]),
             (104, "http://a.example.com/en/rel", '<link rel="canonical" href="/de/2">'),
             (105, "http://b.example.com/x/y", '<link rel="canonical" href="z?a=1&amp;b=2">')]
    edges += [("http://a.example.com/en/rel", "http://a.example.com/de/2"), ("http://b.example.com/x/y", "http://b.example.com/x/z?a=1&b=2")]
    pages = with_clash(spark, spark.createDataFrame(rows, PAGES))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, urls.rule_table(spark)).collect()}
    want = brute([(i, u) for i, u, _ in rows], edges)
    assert got == want
    assert any(r is None and v == "block" for _, _, r, v in want.values())
    plain = brute([(i, u) for i, u, _ in rows], [])
    assert plain != want


LINKS = ["""<meta http-equiv="refresh" content="0;url='https://a.net/x'">""", """<META HTTP-EQUIV='refresh' CONTENT='0; URL = "https://a.net/x"'>""",
         "<meta http-equiv=refresh content=0;url=https://a.net/x>", """<meta content="5; url=https://a.net/x" http-equiv="refresh">""",
         "<link rel=canonical href=https://a.net/x>", "<link href=https://a.net/x rel=canonical />", "<link rel='canonical' href = 'https://a.net/x'>",
         """<link rel="alternate canonical" href="https://a.net/x">""", "<link rel='nofollow\ncanonical external' href=https://a.net/x>",
         """<link data-href=/no rel=" canonical" href="https://a.net/x">"""]
NO_LINKS = ["""<meta http-equiv="refresh" content="0;url=" name="https://a.net/x">""", """<link rel="alternate" title="canonical" href="https://a.net/x">""",
            """<link rel="alternate uncanonical" href=https://a.net/x>""", "<link rel=canonical>", "<link rel=canonical href=>"]


def test_link_forms(spark):
    pages = spark.createDataFrame([(i, f"http://p{i}.example.org/", f"<head>{t}</head>") for i, t in enumerate(LINKS + NO_LINKS)], PAGES)
    assert sorted((r["u"], r["v"]) for r in urls.page_edges(pages).collect()) == sorted(
        (f"http://p{i}.example.org/", "https://a.net/x") for i in range(len(LINKS)))
    blocked = {r["page_id"] for r in urls.judge(pages, urls.rule_table(spark)).where("verdict = 'block'").collect()}
    assert blocked == set(range(len(LINKS)))
    found = {r["u"]: r["v"] for r in urls.page_edges(spark.createDataFrame([(0, "http://q.org/", """<link rel=canonical href="/it's">""")], PAGES)).collect()}
    assert found == {"http://q.org/": "http://q.org/it's"}


def test_redirect_table_long_chain(spark):
    chain = [f"http://h{i}.example.com/p" for i in range(40)] + ["http://bad.net/"]
    edges = spark.createDataFrame(list(zip(chain, chain[1:])), "u string, v string")
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(chain)], PAGES)
    got = urls.judge(pages, urls.rule_table(spark), edges).collect()
    assert {r["verdict"] for r in got} == {"block"} and sum(r["rule"] is None for r in got) == 40


def test_empty_and_many_rules(spark, monkeypatch):
    assert urls.judge(spark.createDataFrame([], PAGES), urls.rule_table(spark)).count() == 0
    pages = spark.createDataFrame([(1, "http://a.example.net/en/x", None), (2, "http://q.org/fr/", None)], PAGES)
    few = sorted(map(tuple, urls.judge(pages, urls.rule_table(spark)).collect()))
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    assert sorted(map(tuple, urls.judge(pages, urls.rule_table(spark)).collect())) == few
    none = urls.judge(pages, urls.rule_table(spark).limit(0)).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.example.net/en/x", "<p>")], PAGES)
    plan = urls.judge(pages, urls.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sql_knows_the_same_link_forms(spark, tmp_path):
    import duckdb
    pages = spark.createDataFrame([(i, f"http://p{i}.example.org/", f"<head>{t}</head>") for i, t in enumerate(LINKS + NO_LINKS)], PAGES)
    pages.toPandas().to_parquet(tmp_path / "p.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p.parquet'")
    got = {r["page_id"]: tuple(r) for r in urls.judge(pages, urls.rule_table(spark)).collect()}
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({urls.OP8_SQL})").fetchall()
    assert sorted(got.values()) == sorted(want) and any(r[4] == "block" for r in want)


def test_hosts_of_many_labels(spark):
    hosts = [".".join(["a"] * 60_000 + ["net"]), ".".join(["b"] * 60_000), "x..example.com", ".net", "."]
    pages = spark.createDataFrame([(i, f"http://{h}/de/1", None) for i, h in enumerate(hosts)], PAGES)
    got = {r["page_id"]: r["rule"] for r in urls.judge(pages, urls.rule_table(spark)).collect()}
    assert got == {0: "net/", 1: None, 2: "example.com/de/", 3: "net/", 4: None}
