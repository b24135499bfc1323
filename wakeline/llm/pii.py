"""Personal data: fixed formats and boosted candidates, as DataFrame SQL.

Formats (always kept): e-mail and IP addresses, card numbers with a valid check
digit, international phone numbers.

Candidates: two high-recall generators propose overlapping spans, address-like
(``a at b dot c``, ``a @ b.c``) and number-like (seven or more digits with single
or double separators). Each candidate is described by bits of its format (digit
count, separators, signs) and of its context (the words before, the character
after). A candidate that overlaps a format's span is a positive example, any
other a negative one; boosted trees are fitted on the counts of (bits, label)
over all documents, four fifths of them by a hash of the id, and calibrated on
the other fifth. Candidates that overlap no format's span and whose calibrated
probability is ``least`` or more are added (kinds address, number).

Patterns whose first part could be tried again at every character of a long run
are anchored at the start of the run (or at the end of the match before) and use
possessive quantifiers; both leave the matches as they are.

Null text: no spans. Repeated rows each get their own result; ids may be null.
Texts of any length are scanned whole. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import boost
from wakeline.llm.columns import number_of, numbered, restored
from wakeline.llm.spans import digest_text, let, matches

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ADDRESS_LIKE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?@\x20?|\x20?[\(\[](?i:at)[\)\]]\x20?|\x20(?i:at)\x20)"
    r"[A-Za-z0-9-]++(?:(?:\.|\x20?[\(\[](?i:dot)[\)\]]\x20?|\x20(?i:dot)\x20)[A-Za-z0-9-]++)++"
)
NUMBER_LIKE = r"(?<![A-Za-z0-9])\+?\(?[0-9](?:[\x20()./-]{0,2}+[0-9])++"
LEAST = 0.5
CONTEXT = 24

#: Bit features of a candidate c: SQL conditions. 17 bits, so the counts that
#: reach the driver are at most 2^17 for each label and fold.
FEATURES = (
    "c.kind = 'number'",
    "lower(c.pre) RLIKE 'mail|contact|write'",
    "lower(c.pre) RLIKE 'tel|phone|call|fax|mobile|sms'",
    "lower(c.pre) RLIKE 'card|visa|account|iban|pay'",
    "lower(c.pre) RLIKE 'host|server|addr|[^a-z]ip[^a-z]'",
    "c.pre RLIKE '[:=][^A-Za-z0-9]{0,2}$'",
    "c.post RLIKE '[A-Za-z0-9]'",
    "c.m LIKE '%@%'",
    "c.m LIKE '+%'",
    "c.m RLIKE '[()]'",
    "c.m LIKE '%-%'",
    "c.m LIKE '% %'",
    "char_length(c.m) - char_length(replace(c.m, '.', '')) = 3",
    "digits >= 9",
    "digits >= 12",
    "digits >= 16",
    "digits >= 20",
)


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _between(m: str, low: int, high: int) -> str:
    return f"char_length({_digits(m)}) BETWEEN {low} AND {high}"


def _luhn(m: str) -> str:
    digit = "CAST(substring(back, i, 1) AS INT)"
    add = f"IF(i % 2 = 1, {digit}, IF({digit} > 4, 2 * {digit} - 9, 2 * {digit}))"
    return let(f"reverse({_digits(m)})", "back", f"aggregate(sequence(1, char_length(back)), 0, (a, i) -> a + {add}) % 10 = 0")


def _formats(text: str) -> list[tuple[str, str]]:
    octet = "regexp_replace(x, '^0+', '')"
    small = f"forall(split({{m}}, '[.]'), x -> char_length({octet}) <= 3 AND coalesce(try_cast(concat('0', {octet}) AS INT), 999) <= 255)"
    return [
        ("email", matches(text, EMAIL, "email", first="@", context=1)),
        ("ip", matches(text, IP, "ip", 0, small, first=r"[0-9]\.[0-9]")),
        ("card", matches(text, CARD, "card", 0, f"{_between('{m}', 16, 19)} AND {_luhn('{m}')}", first="[0-9][- ]?[0-9]")),
        ("phone", matches(text, PHONE, "phone", 0, _between("{m}", 8, 15), first=r"\+[0-9]")),
    ]


def _code() -> str:
    bits = " + ".join(f"IF({f}, {1 << i}, 0)" for i, f in enumerate(FEATURES))
    return let(f"char_length({_digits('c.m')})", "digits", bits)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, also..., base, cands): the formats' spans, and the candidates as
    struct(rank, start, kind, end, code, known), known: overlaps the formats'."""

    text = f"`{text_col}`"
    found = docs.select(
        id_col, *also, *[F.expr(sql).alias(f"_{kind}") for kind, sql in _formats(text)],
        F.expr(matches(text, ADDRESS_LIKE, "address", first=r"@|(?i:[^a-z]at[^a-z])", context=CONTEXT)).alias("_address"),
        F.expr(matches(text, NUMBER_LIKE, "number", 0, f"char_length({_digits('{m}')}) >= 7", first=r"[0-9].?.?[0-9].?.?[0-9]", context=CONTEXT)).alias("_number"),
    )
    plain = "transform(_{k}, s -> named_struct('rank', {r}, 'start', s.start, 'kind', s.kind, 'end', s.end))"
    base = "array_sort(concat({}))".format(", ".join(plain.format(k=k, r=r) for r, k in enumerate(("email", "ip", "card", "phone"))))
    known = "exists(formats, b -> b.start < c.end AND c.start < b.end)"
    row = f"named_struct('rank', IF(c.kind = 'address', 4, 5), 'start', c.start, 'kind', c.kind, 'end', c.end, 'code', {_code()}, 'known', {known})"
    return found.withColumn("base", F.expr(base)).select(
        id_col, *also, "base", F.expr(let("base", "formats", f"transform(concat(_address, _number), c -> {row})")).alias("cands"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> boost.Trees:
    """Fit the trees on the counts over all candidates of ``docs``."""

    rows = candidates(docs, id_col, text_col).select(
        (F.pmod(F.xxhash64(F.col(id_col)), F.lit(5)) == 0).alias("held"), F.explode("cands").alias("c"))
    counts = rows.groupBy("held", F.col("c.code").alias("code")).agg(
        F.sum(F.when(F.col("c.known"), 1).otherwise(0)).alias("pos"), F.count("*").alias("n")).collect()

    def side(held: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = sorted((r.code, r.pos, r.n - r.pos) for r in counts if r.held == held)
        return tuple(np.array(x, dtype=np.int64) for x in zip(*some, strict=True)) if some else (np.zeros(0, dtype=np.int64),) * 3

    return boost.calibrate(boost.fit(*side(False), bits=len(FEATURES)), *side(True))


def _selected(model: boost.Trees, least: float) -> str:
    """All spans in order: the formats', then the candidates selected."""

    more = (
        f"transform(filter(cands, c -> NOT c.known AND {model.sql('c.code')} >= {least!r}D),"
        " c -> named_struct('rank', c.rank, 'start', c.start, 'kind', c.kind, 'end', c.end))"
    )
    return f"CASE WHEN size(cands) = 0 THEN base ELSE array_sort(concat(base, {more})) END"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(id_col, base, spans): arrays of struct(rank, start, kind, end), by kind
    (email, ip, card, phone, address, number), then start."""

    model = fit(docs, id_col, text_col)
    return candidates(docs, id_col, text_col).select(id_col, "base", F.expr(_selected(model, least)).alias("spans"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """Counts by format, and the spans as text."""

    count = "CAST(size(filter(base, s -> s.kind = '{}')) AS BIGINT)"
    return find(docs, id_col, text_col, least).select(
        F.col(id_col), *[F.expr(count.format(k)).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(F.expr(digest_text("base")), 256).alias("base_sha256"), F.expr(digest_text("spans")).alias("spans"))


_BLOCK = 8192


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with every span found replaced by its kind in brackets; spans
    that overlap become one, named by the one that starts first (then by kind).
    A column n_chars, if there is one, gets the new length. The text is worked
    on in blocks of code points, so a long text with many spans stays cheap."""

    model = fit(docs, id_col, text_col)
    rows, key, text = numbered(docs), number_of(docs, id_col), number_of(docs, text_col)
    others = tuple(c for c in rows.columns if c != key)
    spans = _selected(model, least)
    ordered = f"array_sort(transform({spans}, s -> named_struct('start', s.start, 'rank', s.rank, 'kind', s.kind, 'end', s.end)))"
    apart = (
        f"aggregate({ordered}, CAST(array() AS ARRAY<STRUCT<start: BIGINT, rank: INT, kind: STRING, end: BIGINT>>), (acc, s) ->"
        " CASE WHEN size(acc) > 0 AND s.start < element_at(acc, -1).end THEN"
        " concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'rank', element_at(acc, -1).rank,"
        " 'kind', element_at(acc, -1).kind, 'end', greatest(element_at(acc, -1).end, s.end))))"
        " ELSE concat(acc, array(s)) END)"
    )
    off = f"(k * {_BLOCK})"
    start = f"IF(i = 0, 0L, greatest(0L, ss[i - 1].end - {off}))"
    part = (
        f"concat(substring(blk, CAST({start} + 1 AS INT), CAST(greatest(0L, s.start - {off} - {start}) AS INT)),"
        f" IF(s.start >= {off}, concat('[', upper(s.kind), ']'), ''))"
    )
    block = let(
        f"filter(apart, s -> s.end > {off} AND s.start < {off} + {_BLOCK})", "ss",
        f"CASE WHEN size(ss) = 0 THEN blk ELSE concat(array_join(transform(ss, (s, i) -> {part}), ''),"
        f" substring(blk, CAST(element_at(ss, -1).end - {off} + 1 AS INT))) END")
    clean = let(apart, "apart", f"array_join(transform(regexp_extract_all({text}, r'(?s).{{1,{_BLOCK}}}', 0), (blk, k) -> {block}), '')")
    out = candidates(rows, key, text, others).withColumn(
        text, F.expr(f"CASE WHEN size(base) + size(cands) = 0 THEN {text} ELSE {clean} END"))
    if "n_chars" in docs.columns:
        out = out.withColumn(number_of(docs, "n_chars"), F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return restored(out, docs)
