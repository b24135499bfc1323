"""URL filter: parts and rules by hand, reputation against a plain version."""

import math
import re

from wakeline.llm import urls

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
URLS = ["http://WWW.Example.com/en/1?x=/a", "https://m.example.com/en/2", "http://example.com/fr/", "http://a.net/es/1", "http://a.net/en/1#/fr/",
        "ftp://badexample.com/en/9", "http://a.net", "no scheme", "", None, "x://", "http://ÄB.org/é?q", "http://a.b/://c.net/fr/", "http://a.net?/es/",
        "http://u\nv.net/fr/x", "http://net/fr/1"]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return low, re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def bounds(rows, labels):
    count = {}
    for k, u, _ in rows:
        c = count.setdefault(split(u)[0], [0, 0])
        if k in labels:
            c[0] += 1
            c[1] += labels[k]

    def shrink(members, above):
        some = [(n, b) for n, b, _ in members.values() if n]
        N, B, k = sum(n for n, _ in some), sum(b for _, b in some), len(some)
        rho = 0.1
        if k > 1 and N > k:
            b2 = sum(b * b / n for n, b in some)
            msb, msw, n0 = (b2 - B * B / N) / (k - 1), (B - b2) / (N - k), (N - sum(n * n for n, _ in some) / N) / (k - 1)
            if msb + (n0 - 1) * msw > 0:
                rho = min(0.999, max(0.001, (msb - msw) / (msb + (n0 - 1) * msw)))
        s = 1 / rho - 1
        return {m: (b + s * above[up]) / (n + s) for m, (n, b, up) in members.items()}, s

    def tail(h, k):
        return ".".join(h.split(".")[-k:])

    hosts = {h: (n, b, tail(h, 3) if tail(h, 2) in urls.PUBLIC else tail(h, 2)) for h, (n, b) in count.items()}
    dom, suf = {}, {}
    for n, b, d in hosts.values():
        s = tail(d, 2) if tail(d, 2) in urls.PUBLIC else tail(d, 1)
        n0, b0, _ = dom.get(d, (0, 0, s))
        dom[d] = n0 + n, b0 + b, s
    for n, b, s in dom.values():
        n0, b0, _ = suf.get(s, (0, 0, "all"))
        suf[s] = n0 + n, b0 + b, "all"
    top = {"all": (sum(x[1] for x in suf.values()) + 1) / (sum(x[0] for x in suf.values()) + 2)}
    sm, _ = shrink(suf, top)
    dm, _ = shrink(dom, sm)
    hm, s = shrink(hosts, dm)
    return {h: hm[h] - urls.Z * math.sqrt(hm[h] * (1 - hm[h]) / (hosts[h][0] + s + 1)) for h in hosts}


def test_judge(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)]
    for i in range(400):
        rows.append((100 + i, f"http://{'bad' if i % 4 == 0 else f'h{i % 13}'}.site{i % 4}.{'org' if i % 3 else 'co.uk'}/de/{i}", "x"))
    rows += [(None, "http://bad.site0.org/", "x"), (100, rows[16 + 0][1], "x")]
    bad = {100 + i: int(i % 4 == 0 or i % 29 == 0) for i in range(400) if i % 2 == 0 or i % 5 == 0}
    labels = [(k, 1 - b, 0) if k % 2 else (k, 1, b) for k, b in bad.items()] + [(None, 0, 1), (100 + 1, None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    bound = bounds(rows, bad)
    want = []
    for k, u, _ in rows:
        h, p = split(u)
        r, v = rule(h, p)
        want.append((k, h, p, r, v or ("block" if bound[h] > urls.LEAST else "allow")))
    got = urls.judge(pages, lab, RULES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[3] is None and w[4] == "block" for w in want)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert urls.judge(pages, lab, RULES).collect() == []
    one = urls.judge(spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string"), lab, []).first()
    assert tuple(one) == (1, "a.org", "/x", None, "allow")
