"""Secret scans: fixed formats and sliding-window entropy, as DataFrame SQL.

Formats (always kept): assignments to secret-like names with a value of six or
more characters, access keys, long runs of small hexadecimal digits.

Entropy: candidate strings are runs of 20 or more characters of the base64
alphabets, without the words of the allow-list (UUIDs, alphabets in order,
placeholders), which cut a run in parts: no window touches such a word. A window
of 20 characters slides along each part; its Shannon entropy comes from the sum
of c*log2(c) over the counts c of its characters, and a step changes that sum by
the count of the character that leaves and of the one that enters only. The
class of the window's characters sets the least entropy: hexadecimal digits
only; letters of both cases with digits; letters of one case with digits and
nothing else; letters of both cases and nothing else. Other windows (words,
paths) have no threshold. The span found reaches from the first to the last
window of the part at or above its threshold. Spans that overlap a format's
span are not added. Parts are scanned in pieces that overlap by a window less
one character, so the time is linear in the length of a run.

Null text: no spans. Repeated rows each get their own result; ids may be null.
Texts of any length are scanned whole.
"""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.spans import digest_text, let, literal, matches

ASSIGN = r"(?i)(?:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
PIECE = 256
HEX_BITS, MIXED_BITS, ONE_CASE_BITS, LETTER_BITS = 3.05, 3.83, 3.4, 3.83
ONE_CASE_DIGITS = (3, 1)  # least digits beside small letters, beside capitals
LETTER_EACH = 8  # least letters of either case in a window of letters
ALLOWED = (
    r"(?i)\b[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\b|abcdefghij(?:klmnopqrstuvwxyz)?|(?:0123456789)++|x{4,}+"
    r"|example|placeholder|your[-_]?(?:key|token|secret)|dummy|changeme"
)
#: An allow-listed word, or a part between such words.
PART = rf"(?:{ALLOWED})|(?:(?!{ALLOWED})[A-Za-z0-9+/_=-]){{20,}}+"


def _most(win: str) -> str:
    """The greatest sum of c*log2(c) at which window ``win`` is a secret, by
    its class; -1 if its class has none."""

    hexa, mixed, one, letters = (repr(WINDOW * (math.log2(WINDOW) - b)) + "D" for b in (HEX_BITS, MIXED_BITS, ONE_CASE_BITS, LETTER_BITS))
    count = "(char_length(win) - char_length(translate(win, '{}', '')))"
    small, capital = ONE_CASE_DIGITS
    case = (
        f"CASE WHEN win RLIKE '^[0-9A-Fa-f]+$' THEN {hexa} WHEN lo > 0 AND up > 0 AND dig > 0 THEN {mixed}"
        f" WHEN lo + dig = {WINDOW} AND dig >= {small} OR up + dig = {WINDOW} AND dig >= {capital} THEN {one}"
        f" WHEN lo + up = {WINDOW} AND least(lo, up) >= {LETTER_EACH} THEN {letters} ELSE -1D END"
    )
    return let(win, "win", let(count.format(ascii_lowercase), "lo", let(
        count.format(ascii_uppercase), "up", let(count.format(digits), "dig", case))))


def _entropy_runs(part: str) -> str:
    """(first, last): the ends of the first and the last window of ``part``
    that is a secret; last is 0 if none is."""

    w = WINDOW
    loosest = repr(w * (math.log2(w) - min(HEX_BITS, MIXED_BITS, ONE_CASE_BITS, LETTER_BITS))) + "D"
    term = "(k * log2(greatest(k, 1)))"
    gain = f"({term.replace('k', '(k + 1)').replace('greatest((k + 1), 1)', '(k + 1)')} - {term})"
    count = "CAST(char_length(both) - char_length(replace(both, {c}, '')) AS DOUBLE)"
    enter = let(count.format(c="substring(piece, i, 1)"), "k", gain)
    leave = f"CASE WHEN i > {w} THEN {let(count.format(c=f'substring(piece, i - {w}, 1)'), 'k', gain)} ELSE 0D END"
    both = f"substring(piece, greatest(1, i - {w - 1}), least(i - 1, {w - 1}))"
    hit = f"CASE WHEN i >= {w} AND s2 <= {loosest} THEN s2 <= {_most(f'substring(piece, i - {w - 1}, {w})')} ELSE false END"
    step = let(let(both, "both", f"acc.s - {leave} + {enter}"), "s2", let(
        hit, "hit", "named_struct('s', s2, 'first', IF(hit AND acc.first = 0, i, acc.first), 'last', IF(hit, i, acc.last))"))
    run = f"aggregate(sequence(1, char_length(piece)), named_struct('s', 0D, 'first', 0, 'last', 0), (acc, i) -> {step})"
    ends = let(run, "e", f"named_struct('first', IF(e.last > 0, e.first + j * {PIECE}, 2147483647), 'last', IF(e.last > 0, e.last + j * {PIECE}, 0))")
    cut = literal(f"(?=(.{{1,{PIECE + w - 1}}})).{{1,{PIECE}}}")
    return let(
        f"transform(regexp_extract_all({part}, {cut}, 1), (piece, j) -> {ends})", "ends",
        "named_struct('first', array_min(transform(ends, e -> e.first)), 'last', array_max(transform(ends, e -> e.last)))")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, base, spans): arrays of struct(kind, start, end) by start, then
    assign, access, hex, entropy; ``base`` without the last kind."""

    text = f"`{text_col}`"
    found = docs.select(
        F.col(id_col),
        F.expr(matches(text, ASSIGN, "assign", 1, "char_length({g}) >= 6", first=r"(?i)password|passwd|secret|token|api_?key")).alias("assign"),
        F.expr(matches(text, ACCESS, "access")).alias("access"),
        F.expr(matches(text, HEX, "hex")).alias("hexa"),
        F.expr(matches(text, CANDIDATE, "entropy", 0, "{m} RLIKE '[0-9]' OR {m} RLIKE '[a-z]' AND {m} RLIKE '[A-Z]' OR {m} RLIKE '[A-Fa-f]{20}'")).alias("cands"),
    )
    plain = "transform({a}, s -> named_struct('start', s.start, 'rank', {r}, 'kind', s.kind, 'end', s.end))"
    parts = matches("c.m", PART, "entropy", 0, f"NOT {{m}} RLIKE {literal(ALLOWED)}", first=CANDIDATE)
    runs = let("base", "formats", let(
        f"flatten(transform(cands, c -> transform({parts}, q -> {let(_entropy_runs('q.m'), 'e', bound())})))", "r",
        "filter(r, x -> x.end > 0 AND NOT exists(formats, b -> b.start < x.end AND x.start < b.end))"))
    base = "array_sort(concat({}, {}, {}))".format(*(plain.format(a=a, r=r) for r, a in enumerate(("assign", "access", "hexa"))))
    return (
        found.withColumn("base", F.expr(base))
        .withColumn("more", F.expr(f"CASE WHEN size(cands) = 0 THEN CAST(array() AS ARRAY<STRUCT<start: BIGINT, rank: INT, kind: STRING, end: BIGINT>>) ELSE {runs} END"))
        .select(id_col, "base", F.expr("CASE WHEN size(more) = 0 THEN base ELSE array_sort(concat(base, more)) END").alias("spans"))
    )


def bound() -> str:
    """The span of a part ``q`` of candidate ``c`` whose secret windows end at
    e.first .. e.last."""

    return (
        "named_struct('start', IF(e.last > 0, c.start + q.start + e.first - " + str(WINDOW) + ", 0L), 'rank', 3, 'kind', 'entropy',"
        " 'end', IF(e.last > 0, c.start + q.start + e.last, 0L))"
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by format, and the spans as text."""

    count = "CAST(size(filter(base, s -> s.kind = '{}')) AS BIGINT)"
    return scan(docs, id_col, text_col).select(
        F.col(id_col), *[F.expr(count.format(k)).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.expr(digest_text("base")), 256).alias("base_sha256"), F.expr(digest_text("spans")).alias("spans"))
