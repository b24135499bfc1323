"""License scans: ordered signature rules, as DataFrame SQL.

Words are runs of ASCII letters, digits and all characters beyond ASCII, with
A-Z in lower case. One look-up of a text's words among the first words of all
keywords is the prefilter; texts that pass get a space on either side of every
word. There the base phrases are counted, and the rules (``license_rules.py``,
about three hundred) with a keyword in the text are matched; each one's matches
are intervals of words. A match is suppressed if it lies within another one of a
stronger level, or within a longer or (if equal) earlier one of its own level;
matches that merely overlap both stay. For that the matches are sorted by start,
the longer and stronger first, and each one is compared with the largest end seen
before it at its level or a stronger one, block by block, so the work stays
near linear in the number of matches.

``labels`` are those of the matches left and of the base phrases. ``score`` is
1 - 2^-p, where p adds up, over the labels found, the points of the strongest
match left of each: 5 for an identifier tag down to 1 for a mention.

Null text: no words, no labels, score 0; first and last word are null without a
base phrase. Repeated rows each get their own result, ids may be null; texts of
any length are scanned whole. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.license_rules import Rule, read_rules, spaced
from wakeline.llm.spans import let, literal

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Points of a level's match towards the score.
POINTS = {1: 5, 2: 4, 3: 3, 4: 2, 5: 1, 6: 1}
MOST_POINTS = 50
_BLOCK = 64
_HIT = "STRUCT<start: BIGINT, back: BIGINT, level: INT, rank: INT, label: STRING, end: BIGINT>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    """The words of ``text``, with an empty string before and behind them where
    the text begins or ends with other characters. Only two characters beyond
    ASCII have an ASCII letter in lower case; texts with one of them take the
    slower way."""

    low = f"IF(contains({text}, 'K') OR contains({text}, 'İ'), translate({text}, '{_UPPER}', '{_LOWER}'), lower({text}))"
    return f"coalesce(split({low}, {literal(SEPARATORS)}, -1), array(''))"


def _count(text: str) -> str:
    """Number of words of a piece of such a text."""

    return f"((char_length({text}) - char_length(replace({text}, ' ', ''))) DIV 2)"


def _matches(words: str, rule: str) -> str:
    """Intervals of words at which ``rule`` matches."""

    n = _BLOCK
    start = (
        f"(aggregate(slice(sums, 1, CAST(i DIV {n} AS INT)), 0L, (a, b) -> a + b)"
        f" + aggregate(slice(steps, CAST(i DIV {n} AS INT) * {n} + 1, i % {n}), 0L, (a, b) -> a + b) + {_count('parts[i]')})"
    )
    hit = (
        f"named_struct('start', at, 'back', -(at + {_count('m')}), 'level', {rule}.level, 'rank', {rule}.rank, 'label', {rule}.label,"
        f" 'end', at + {_count('m')})"
    )
    body = let(f"split({words}, {rule}.pattern, -1)", "parts", let(
        f"zip_with(slice(parts, 1, size(ms)), ms, (p, m) -> {_count('p')} + {_count('m')})", "steps", let(
            f"transform(sequence(0, CAST(size(ms) DIV {n} AS INT)), k -> aggregate(slice(steps, k * {n} + 1, {n}), 0L, (a, b) -> a + b))", "sums",
            f"transform(ms, (m, i) -> {let(start, 'at', hit)})")))
    return let(f"regexp_extract_all({words}, {rule}.pattern, 0)", "ms", f"IF(size(ms) = 0, CAST(array() AS ARRAY<{_HIT}>), {body})")


def detections(words: str, seen: str, rules: Sequence[Rule]) -> str:
    """All matches, sorted, of the rules with a keyword in ``words``, a text
    whose words that begin a keyword are ``seen``."""

    phrases = list(dict.fromkeys(k for r in rules for k in r.keywords))
    known = ", ".join(f"named_struct('word', '{k.split()[0]}', 'phrase', '{k}')" for k in phrases)
    table = ", ".join(
        f"named_struct('rank', {r.rank}, 'level', {r.level}, 'label', '{r.label}', 'keywords', array({', '.join(map(repr, r.keywords))}),"
        f" 'pattern', {literal(r.pattern)})" for r in rules)
    present = f"transform(filter(array({known}), k -> array_contains({seen}, k.word) AND contains({words}, k.phrase)), k -> k.phrase)"
    found = f"flatten(transform(filter(array({table}), r -> arrays_overlap(present, r.keywords)), r -> {_matches(words, 'r')}))"
    none = f"CAST(array() AS ARRAY<{_HIT}>)"
    return f"IF({words} = '', {none}, {let(present, 'present', f'IF(size(present) = 0, {none}, array_sort({found}))')})"


def unsuppressed(hits: str) -> str:
    """The sorted matches that no earlier one of their level or a stronger one
    contains."""

    n, levels = _BLOCK, sorted(POINTS)
    largest = "aggregate({a}, 0L, (e, x) -> IF(x.level <= {level}, greatest(e, x.end), e))"
    each = "array(" + ", ".join(largest.format(a="b", level=level) for level in levels) + ")"
    block = let(f"slice({hits}, k * {n} + 1, {n})", "b", each)
    blocks = f"transform(sequence(0, CAST(size({hits}) DIV {n} AS INT)), k -> {block})"
    before = (
        f"greatest(aggregate(slice(tops, 1, CAST(i DIV {n} AS INT)), 0L, (e, t) -> greatest(e, element_at(t, d.level))),"
        f" {largest.format(a=f'slice({hits}, CAST(i DIV {n} AS INT) * {n} + 1, i % {n})', level='d.level')})"
    )
    return let(blocks, "tops", f"filter({hits}, (d, i) -> {before} < d.end)")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """(id_col, n_words, words, hits, kept): the number of words, the text's words
    with spaces around them (left empty where nothing can match), the sorted
    matches, and those left, as arrays of struct(start, back, level, rank, label,
    end); ``start`` and ``end`` count words, ``back`` is -end."""

    rules = read_rules() if rules is None else rules
    gate = dict.fromkeys([p.split()[0] for p in BASE] + [k.split()[0] for r in rules for k in r.keywords])
    split = docs.select(F.col(f"`{id_col}`").alias("id"), F.expr(_words(f"`{text_col}`")).alias("list"))
    seen = split.select(
        "id", F.expr("size(list) - IF(list[0] = '', 1, 0) - IF(size(list) > 1 AND list[size(list) - 1] = '', 1, 0)").cast("long").alias("n_words"),
        F.expr(f"array_intersect(list, array({', '.join(map(repr, gate))}))").alias("seen"), "list")
    joined = "concat(' ', trim(BOTH ' ' FROM array_join(list, '  ')), ' ')"
    words = seen.select("id", "n_words", "seen", F.expr(f"IF(size(seen) = 0, '', {joined})").alias("words"))
    found = words.select("id", "n_words", "words", F.expr(detections("words", "seen", rules)).alias("hits"))
    return found.select(
        F.col("id").alias(id_col), "n_words", "words", "hits", F.expr(f"IF(size(hits) < 2, hits, {unsuppressed('hits')})").alias("kept"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels,
    score, detections): base places, labels and score of every text, and the
    matches left as label:start:end."""

    scanned = scan(docs, id_col, text_col, rules)
    n, first, last, on = [], [], [], []
    for phrase, label in BASE.items():
        piece, size = spaced(phrase), len(phrase.split())
        n.append(f"(char_length(words) - char_length(replace(words, '{piece}', ''))) DIV {len(piece)}")
        first.append(f"IF(contains(words, '{piece}'), {_count(f'substring_index(words, {literal(piece)}, 1)')}, NULL)")
        last.append(f"IF(contains(words, '{piece}'), n_words - {size} - {_count(f'substring_index(words, {literal(piece)}, -1)')}, NULL)")
        on.append(f"IF(contains(words, '{piece}'), '{label}', NULL)")
    points = "CASE level " + " ".join(f"WHEN {k} THEN {v}" for k, v in POINTS.items()) + " END"
    total = (
        "aggregate(array_distinct(transform(kept, d -> d.label)), 0, (p, name) -> p + "
        + let("array_min(transform(filter(kept, d -> d.label = name), d -> d.level))", "level", points) + ")"
    )
    return scanned.withColumn("base", F.expr(f"array_compact(array({', '.join(on)}))")).select(
        F.col(id_col), "n_words", F.expr(" + ".join(n)).alias("n_base"),
        F.expr(f"CAST(array_min(array({', '.join(first)})) AS BIGINT)").alias("first_word"),
        F.expr(f"CAST(array_max(array({', '.join(last)})) AS BIGINT)").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(base)), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(base, transform(kept, d -> d.label)))), ',')").alias("labels"),
        F.expr(f"1D - pow(2D, -least({MOST_POINTS}, {total}))").alias("score"),
        F.expr("array_join(transform(kept, d -> concat(d.label, ':', d.start, ':', d.end)), ',')").alias("detections"))
