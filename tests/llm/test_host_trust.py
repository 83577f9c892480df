import random
import re
from collections import defaultdict

from procurelens.llm import host_trust as ht

AZ = str.maketrans(ht.UPPER, ht.LOWER)


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(AZ), re.match("[^?#]*", rest[len(host) :])[0]


def plain(pages, rules, rounds=ht.ROUNDS):
    """Rows of judged_pages by dictionaries."""
    rows, counts, links = [], defaultdict(lambda: [0, 0]), set()
    for page_id, url, html in pages:
        host, path = cut(url)
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = min(fits, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[0] + r[1], r[2] != "block"), default=None)
        rows.append((page_id, host, path, best))
        if best and host:
            counts[host][best[2] == "block"] += 1
        for scheme, target in re.findall(r"""href\s*=\s*["']?\s*([a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#"'<>\x00-\x20]+)""", html or "", re.I | re.A):
            if host and target.translate(AZ) != host:
                links.add((host, target.translate(AZ)))
    scores = []
    for side in (0, 1):
        ways = defaultdict(list)
        for a, b in links:
            ways[(a, b)[side]].append((b, a)[side])
        start = {h: ht.UNIT * c[side] // sum(c) * 3 // 20 for h, c in counts.items() if ht.UNIT * c[side] // sum(c)}
        now = dict(start)
        for _ in range(rounds):
            after = defaultdict(int, start)
            for h, score in now.items():
                for t in ways[h]:
                    after[t] += score * 17 // (20 * len(ways[h]))
            now = dict(after)
        scores.append(now)
    out = []
    for page_id, host, path, best in rows:
        trust, distrust = scores[0].get(host, 0), scores[1].get(host, 0)
        verdict = best[2] if best else "block" if distrust > 0 and distrust >= trust else "allow"
        out.append((page_id, host, path, best[0] + best[1] if best else None, verdict, trust, distrust))
    return out


def judge(spark, pages, rules, **options):
    frame = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, Host int, rule string")
    return [tuple(r) for r in ht.judged_pages(spark, frame, rules, **options).collect()]


def key(row):
    return tuple((x is None, str(x)) for x in row)


def test_hosts_and_rules(spark):
    urls = [
        "http://WWW.Example.com/en/x?q#f", "https://example.com/en/", "https://a.b.example.com/EN/", "http://example.com", "x.com/en/",
        "http://notexample.com/en/1", "http://shop.net/es/1", "http://net/fr/", "http://shop.net/de/", "ftp://u@h.org:80?x://y.com/", None,
        "http:///en/", "://a.com//en/", "http://ÉÀ.COM/é", "a://b.net/es/://c.com/",
    ]
    pages = [(i, u, None) for i, u in enumerate(urls)]
    assert sorted(judge(spark, pages, ht.RULES), key=key) == sorted(plain(pages, ht.RULES), key=key)
    got = {r[0]: r[3:5] for r in judge(spark, pages, ht.RULES)}
    assert got[0] == ("www.example.com/en/", "allow") and got[1] == ("example.com/en/", "block") and got[2] == ("com/", "allow")
    assert got[3][0] is None and got[5] == ("com/", "allow") and got[6] == ("net/es/", "block") and got[10] == (None, "allow")


def test_ties_between_rules_and_repeated_rules(spark):
    rules = [("b.c", "/x", "allow"), ("c", "/x/y", "block"), ("b.c", "/x", "block"), ("c", "/x/y", "block")]
    pages = [(1, "http://a.b.c/x/y/z", ""), (2, "http://c/x/y", ""), (2, "http://c/x/y", ""), (None, "http://b.c/", "")]
    assert sorted(judge(spark, pages, rules), key=key) == sorted(plain(pages, rules), key=key)
    assert judge(spark, [], rules) == [] and {r[4] for r in judge(spark, pages, [])} == {"allow"}


def test_distrust_flows_against_links(spark):
    link = lambda *hosts: "".join(f"<a HREF = '//{h}/p'>x</a><a href=\"/en/\">y</a>" for h in hosts)
    rules = [("good.org", "/", "allow"), ("bad.org", "/", "block")]
    pages = [
        (1, "http://good.org/", link("near.org", "GOOD.org")), (2, "http://bad.org/", link("good.org", "victim.org")),
        (3, "http://friend.org/", link("bad.org")), (4, "http://far.org/", '<a href=https://friend.org>z</a>'),
        (5, "http://near.org/", ""), (6, "http://victim.org/", None), (7, "http://alone.org/", link("alone.org")),
        (8, "http://good.org/x", link("near.org")),
    ]
    got = judge(spark, pages, rules)
    assert sorted(got, key=key) == sorted(plain(pages, rules), key=key)
    assert {r[1]: r[4] for r in got} == {
        "good.org": "allow", "bad.org": "block", "friend.org": "block", "far.org": "block", "near.org": "allow",
        "victim.org": "allow", "alone.org": "allow"}


def test_random_graph_matches_plain_python(spark):
    rng = random.Random(4)
    hosts = [f"h{i}.{rng.choice(['com', 'net', 'example.com', 'org'])}" for i in range(25)]
    pages = []
    for i in range(120):
        links = "".join(f"<a href='https://{rng.choice(hosts)}/{j}'>" for j in range(rng.randint(0, 3)))
        pages.append((i, f"http://{rng.choice(hosts)}/{rng.choice(['en', 'fr', 'es', 'de'])}/{i}", links))
    for rounds in (3, ht.ROUNDS):
        got = sorted(judge(spark, pages, ht.RULES, rounds=rounds), key=key)
        assert got == sorted(plain(pages, ht.RULES, rounds), key=key)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}
