"""Regular-expression matches with their places, as SQL expression text.

Spark's functions give the matches and the pieces between them; the places
follow by adding lengths up. Lengths are in code points. Running sums go over
blocks of lengths, so a text with very many matches stays far from quadratic.
"""

from __future__ import annotations

_BLOCK = 256


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is worked out once."""

    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def literal(pattern: str) -> str:
    """A pattern as a raw SQL string (patterns here hold no quotes)."""

    assert "'" not in pattern
    return f"r'{pattern}'"


def matches(text: str, pattern: str, kind: str, group: int = 0, keep: str = "true", context: int = 0, first: str | None = None) -> str:
    """Array of struct(kind, start, end, m, pre, post): the leftmost
    non-overlapping matches of ``pattern`` that satisfy ``keep``, a condition on
    the match ``m`` and on group ``group`` of it as ``g``. ``pre`` is up to
    ``context`` code points before the match and after the previous one,
    ``post`` the next code point. ``first`` is a pattern (or a condition, if it
    holds a parenthesis) that any text with a match satisfies. Null text: an
    empty array."""

    pat = literal(pattern)
    n = _BLOCK
    start = (
        f"(aggregate(slice(blocks, 1, CAST(i DIV {n} AS INT)), 0L, (a, b) -> a + b)"
        f" + aggregate(slice(adv, CAST(i DIV {n} AS INT) * {n} + 1, i % {n}), 0L, (a, b) -> a + b) + char_length(parts[i]))"
    )
    pre = f"right(parts[i], {context})" if context else "''"
    post = "left(parts[i + 1], 1)" if context else "''"
    row = let(start, "at", f"named_struct('kind', '{kind}', 'start', at, 'end', at + char_length(m), 'm', m, 'g', gs[i], 'pre', {pre}, 'post', {post})")
    body = let(
        f"split(text_, {pat}, -1)", "parts", let(
            f"regexp_extract_all(text_, {pat}, 0)", "ms", let(
                f"regexp_extract_all(text_, {pat}, {group})" if group else "ms", "gs", let(
                    "zip_with(slice(parts, 1, size(ms)), ms, (a, b) -> CAST(char_length(a) + char_length(b) AS BIGINT))", "adv", let(
                        f"transform(sequence(0, CAST(size(ms) DIV {n} AS INT)), k -> aggregate(slice(adv, k * {n} + 1, {n}), 0L, (a, b) -> a + b))",
                        "blocks", f"transform(filter(transform(ms, (m, i) -> {row}), s -> {_on(keep)}),"
                        " s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'm', s.m, 'pre', s.pre, 'post', s.post))")))))
    body = let(text, "text_", body)
    empty = "CAST(array() AS ARRAY<STRUCT<kind: STRING, start: BIGINT, end: BIGINT, m: STRING, pre: STRING, post: STRING>>)"
    return f"CASE WHEN {text} RLIKE {literal(first or pattern)} THEN {body} ELSE {empty} END"


def _on(keep: str) -> str:
    return keep.replace("{m}", "s.m").replace("{g}", "s.g")


def digest_text(spans: str) -> str:
    """kind:start:end of each span, joined by commas."""

    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
