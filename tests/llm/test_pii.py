"""Personal data against a scan by Python's regular expressions."""

import hashlib
import random
import re

import numpy as np

from wakeline.llm import boost, pii


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


def slow(text):
    t, out = text or "", []
    out += [(0, m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end(), "card"))
    out += [(3, m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def as_text(spans):
    return ",".join(f"{k}:{a}:{b}" for _, a, b, k in spans)


def card(rnd, n=16):
    d = "".join(rnd.choices("0123456789", k=n - 1))
    return next(d + c for c in "0123456789" if luhn(d + c))


def cases():
    rnd = random.Random(8)
    out = [None, "", "no data, 12 é 🎉", "a@b.c_d@e.f x", "..a%b+c@d-e.co.uk.", "x@y", "@a.b", "a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255",
           "0001.02.3.4", "1.2.3", "99999999999999999999.1.1.1", "+1 (555) 010-99", "+1", "+44 20 7946 0958 ", "+123456789012345678",
           "card " + card(rnd) + ".", "é" + "-".join(card(rnd)) + "9", card(rnd, 19) + " " + card(rnd, 17), "5" * 16, "7" * 9000,
           "a" * 20000 + "@", "1 " * 9000, "john at host dot com", "mail me: jo [at] ex [dot] org", "jo @ ex.org", "call 555-010-1234 now",
           "🎉" * 9000 + " a@b.cd " + "🎉" * 9000 + "1.2.3.4", " ".join("u%d@h.org" % i for i in range(900))]
    for i in range(120):
        out.append(rnd.choice(["mail ", "contact: ", "see "]) + f"u{i}@h{i}.example.org and " + rnd.choice(["ip ", "host "]) + f"10.0.{i}.9, "
                   + rnd.choice(["call ", "tel: "]) + f"+1 555 {i:03d} 1234; card {card(rnd)} ref {rnd.randint(10**7, 10**9)}")
    return out


def frame(spark):
    rows = [(i, t, "clash") for i, t in enumerate(cases())] + [(None, "x a@b.cd", "c"), (5, "1.2.3.4", "c"), (5, "1.2.3.4", "c")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_base(spark):
    rows, docs = frame(spark)
    got = pii.report(docs).collect()
    key = lambda x: str(x)
    want = []
    for k, t, _ in rows:
        s = slow(t)
        want.append((k, *[sum(x[3] == kind for x in s) for kind in ("email", "ip", "card", "phone")],
                     hashlib.sha256(as_text(s).encode()).hexdigest(), as_text(s)))
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans[: len(w)]) for r, w in (
        (r, next(w[6] for w in want if w[0] == r.doc_id and w[5] == r.base_sha256)) for r in got)), key=key) == sorted(want, key=key)
    assert pii.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_redact(spark):
    rows, docs = frame(spark)
    spans = {}
    for r in pii.find(docs).collect():
        spans.setdefault((r.doc_id), []).append(r.spans)
    for r in pii.redact(docs).collect():
        source = [t for k, t, _ in rows if k == r.doc_id][0]
        if source is None:
            assert r.text is None
            continue
        found = sorted((s.start, s.rank, s.end, s.kind) for s in spans[r.doc_id][0])
        want, pos, low, name = "", 0, None, None
        for a, _, b, kind in [*found, (1 << 60, 0, 0, "")]:
            if low is not None and a >= high:
                want += source[pos:low] + f"[{name.upper()}]"
                pos, low = high, None
            if low is None:
                low, high, name = a, b, kind
            high = max(high, b)
        want += source[pos:]
        assert r.text == want and r.spans == "clash" or r.spans == "c"


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(1)
    code = np.arange(64)
    truth = ((code & 1) ^ (code >> 3 & 1)) == 1
    n = rng.integers(20, 60, 64)
    pos = np.where(truth, n - 1, 1)
    model = boost.calibrate(boost.fit(code, pos, n - pos, bits=6), code, pos, n - pos)
    p = 1 / (1 + np.exp(-(model.offset + model.slope * model.score(code))))
    assert ((p > 0.5) == truth).all() and abs((p * n).sum() - pos.sum()) < 0.05 * pos.sum()
    assert boost.fit(code[:0], pos[:0], pos[:0], bits=6).trees == []


def test_trees_in_sql(spark):
    code = np.arange(32)
    model = boost.calibrate(boost.fit(code, code % 7, 7 - code % 7, bits=5), code, code % 7, 7 - code % 7)
    got = [r.p for r in spark.range(32).selectExpr(f"{model.sql('CAST(id AS INT)')} AS p").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-(model.offset + model.slope * model.score(code)))))


def test_plan_is_native(spark):
    _, docs = frame(spark)
    plan = pii.redact(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
