"""Secret scan against a scan by Python's regular expressions."""

import hashlib
import math
import random
import re
import time

from wakeline.llm import secrets

ALLOWED = re.compile(secrets.ALLOWED)


def least(window):
    """The threshold of one window, none if its class has none."""

    lo, up, dig = (sum(a <= c <= b for c in window) for a, b in ("az", "AZ", "09"))
    if re.fullmatch("[0-9A-Fa-f]+", window):
        return 3.05
    if lo and up and dig:
        return 3.83
    if lo + dig == 20 and dig >= 3 or up + dig == 20 and dig >= 1:
        return 3.4
    return 3.83 if lo + up == 20 and min(lo, up) >= 8 else None


def parts(run, at):
    for m in ALLOWED.finditer(run):
        yield at[0], run[at[1]: m.start()]
        at = at[0] + m.end() - at[1], m.end()
    yield at[0], run[at[1]:]


def slow(text):
    t, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    base = sorted(out)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t):
        for start, c in parts(m[0], (m.start(), 0)):
            hits = []
            for i in range(len(c) - 19):
                w = c[i: i + 20]
                bits = least(w)
                if bits and -sum((p := w.count(x) / 20) * math.log2(p) for x in set(w)) >= bits:
                    hits.append(i)
            if hits:
                a, b = start + hits[0], start + hits[-1] + 20
                if not any(s[0] < b and a < s[3] for s in base):
                    out.append((a, 3, "entropy", b))
    text_of = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
    n = [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]
    return (*n, hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(out))


def cases():
    rnd = random.Random(4)
    alpha = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    key = lambda n: "".join(rnd.choices(alpha, k=n))
    out = [
        None, "", "plain é words 🎉", 'token = "abc123def"', "token=abc secret: 'xyz'", "secret=token:abcdefgh", "PassWord:hunter2!!",
        "AKIA" + "A" * 16, "AKIA" + "A" * 15, "XAKIAAKIA" + "B" * 14, "0" * 24, "0" * 23, "é" * 5 + "deadbeef" * 4 + "🎉" + "cafe" * 7,
        "api_key='" + key(30) + "'", "use " + key(40) + " now", "a " + key(20) + "==", "8f14e45f-ceea-467f-ab12-0123456789ab",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabc123", "your_key_" + key(25), "thisIsALongWordWithNumber1AndMoreLetters",
        "x" * 30 + key(25) + "y" * 30, "K=" + "0A1B2C3D4E5F6789" * 3, "token:" * 40 + "abcdefg", "a=1;token   =   \"" + key(60),
        " ".join(key(24) for _ in range(700)), "w " * 20000 + key(33),
    ]
    out += ["".join(rnd.choices(alpha[26:62], k=40)), "".join(rnd.choices(alpha[:26] + "234567", k=32)), "docs/example/" + key(40),
            "".join(rnd.choices(alpha[:52], k=30)), "example" + key(30) + "DUMMY/" + key(22) + "xxxxx" + key(19), "q" + key(900),
            "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "aLongCamelCaseNameOfAClass", "path/to/some/file_name-with-words"]
    return out + [key(rnd.randint(20, 45)) + rnd.choice([" ", "é", "."]) + key(rnd.randint(5, 60)) for _ in range(60)]


def test_scan(spark):
    rows = [(i, t, "clash") for i, t in enumerate(cases())]
    rows += [(None, "token=abcdef", "c"), (0, 'token = "abc123def"', "c"), (0, 'token = "abc123def"', "c")]
    got = secrets.report(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    want = sorted((str(k), *slow(t)) for k, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in got) == want
    assert any("entropy" in w[-1] for w in want)
    assert secrets.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_classes_and_allow_list(spark):
    rnd = random.Random(9)
    make = {
        "small": lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=40)),
        "base32": lambda: "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=32)),
        "beside": lambda: "docs/example/" + "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40)),
    }
    rows = [(f"{name}{i}", f"see {make[name]()} there") for name in make for i in range(50)]
    plain = ["some/ordinary/path/of/many/words", "AVeryLongCamelCaseIdentifierName", "counterrevolutionaries" * 2, "well-known-hyphenated-words-2024",
             "8f14e45f-ceea-467f-ab12-0123456789ab", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "=" * 60, "_" * 40]
    rows += [(f"plain{i}", t) for i, t in enumerate(plain)]
    got = {r.doc_id: r.spans for r in secrets.report(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert all("entropy" in got[i] for i, _ in rows if not i.startswith("plain"))
    assert [got[f"plain{i}"] for i in range(len(plain))] == [""] * len(plain)


def test_long_run(spark):
    rnd = random.Random(3)
    run = "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWYZabcdefghijklmnopqrstuvwyz0123456789+/", k=1 << 20))  # no row of x by chance

    def secret(i):
        w = run[i: i + 20]
        return (bits := least(w)) and -sum((p := w.count(x) / 20) * math.log2(p) for x in set(w)) >= bits

    first, last = (next(i for i in order if secret(i)) for order in (range(len(run)), range(len(run) - 20, 0, -1)))
    began = time.time()
    got = secrets.report(spark.createDataFrame([(1, "data " + run + " end")], "doc_id long, text string")).collect()
    assert got[0].spans == f"entropy:{5 + first}:{25 + last}" and time.time() - began < 60


def test_plan_is_native(spark):
    plan = secrets.report(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
