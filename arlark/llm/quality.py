"""Quality rules: a threshold table compiled into one projection of built-in expressions.

``RULES`` holds one row per rule: a ratio of two measures and the bounds it must
keep.  ``assess`` turns the table and the measures into one ``select`` -- no
user functions, no shuffle -- and ``apply_rules`` keeps the documents that no
rule rejects.  Ratios are compared as integers (bound * denominator in
thousandths), so results do not depend on rounding.

Words are ``[^\\x20\\x09-\\x0D]+``.  Rows: null and empty texts have no words and
fail the base rule; every text is judged by the same rules, whatever its language
label; repeated rows are judged each; any other columns of the input pass
through ``apply_rules`` unread, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arlark.llm.common import SPACE_CLASS

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
SPACES = "".join(map(chr, (0x20, *range(0x09, 0x0E))))

#: Frequent function words by language.
STOP_WORDS = [
    # English
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with", "as", "on", "be", "at", "by", "this",
    # French
    "la", "le", "les", "de", "des", "et", "en", "un", "une", "est", "que", "du", "au",
    # Spanish
    "el", "los", "las", "y", "por", "con", "del", "se", "lo", "al",
    # German
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "ein", "eine", "im", "nicht", "auf",
    # Italian, Portuguese
    "il", "di", "che", "per", "non", "si", "da", "o", "os", "do", "em", "para", "um", "uma",
    # Dutch, Swedish, Danish, Norwegian
    "het", "een", "van", "och", "att", "som", "det", "er", "og", "til", "av", "på",
    # Polish, Czech
    "i", "w", "z", "na", "nie", "jest", "że", "je", "v", "že",
    # Russian, Ukrainian
    "и", "в", "не", "на", "что", "с", "по", "та", "що", "до",
    # Finnish, Hungarian, Turkish
    "ja", "on", "ei", "että", "oli", "az", "és", "hogy", "nem", "ve", "bir", "bu",
]
#: A word found so often in a text is common there, for texts without words of the list.
COMMON_FROM = 3
#: Common words that a text has at least (thousandths).
LEAST_COMMON = 10


@dataclass(frozen=True)
class Rule:
    """``least <= 1000 * top / bottom <= most``, judged only where ``bottom`` is at least ``from_bottom``."""

    name: str
    top: str
    bottom: str
    least: int | None = None
    most: int | None = None
    from_bottom: int = 1


#: The threshold table (thousandths).
RULES = [
    Rule("word_length", "word_chars", "n_words", least=2_000, most=20_000),
    Rule("symbols", "n_symbols", "word_chars", most=100),
    Rule("common_words", "n_common_words", "n_words", least=LEAST_COMMON, from_bottom=50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=300, from_bottom=4),
    Rule("short_lines", "n_short_lines", "n_lines", most=900, from_bottom=10),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=900, from_bottom=10),
]

#: Base limits: words at least, and words inside repeated windows at most (percent).
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Words of a repeated window.
WINDOW = 3

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_words", "n_lines",
            "n_short_lines", "n_bullet_lines"]


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda variable is never inlined again by the optimizer."""
    return F.transform(F.array(value), body)[0]


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _windows(words: Column) -> Column:
    """One xxhash64 for each window of ``WINDOW`` words, in order (no windows in shorter texts)."""
    return F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))


def repeated_words(words: Column) -> Column:
    """Words inside windows that occur twice or more in the text.

    Most texts have no two windows of equal hash and end there.  Else windows
    are sorted by (hash, words), so equal ones are neighbours -- compared by
    their words, not by hash -- and the covered positions are counted from the sorted
    starts: a start covers ``WINDOW`` words, or fewer up to the next start.
    """
    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def starts(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(x["w"] == F.get(ordered, j)["w"], F.lit(False))
        return F.array_sort(F.transform(F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["at"]))

    def exact(hashes: Column) -> Column:
        rows = F.transform(hashes, lambda h, i: F.struct(
            h.alias("h"), F.slice(words, i + 1, F.lit(WINDOW)).alias("w"), i.alias("at")))
        return _bind(F.array_sort(rows), lambda ordered: _bind(starts(ordered), covered))

    return _bind(_windows(words), lambda hashes: F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes), exact(hashes)).otherwise(F.lit(0))).cast("long")


def common_words(words: Column) -> Column:
    """Words of the list; where these are too few, words found ``COMMON_FROM`` times or more in the text.

    Running text has words of its language that come back; strings of letters have none.
    """
    def often(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(ordered, j) == x, F.lit(False))
        # one of the windows of COMMON_FROM sorted words around the word holds nothing else
        def inside(x: Column, i: Column) -> Column:
            found = F.lit(False)
            for first in range(1 - COMMON_FROM, 1):
                whole = F.lit(True)
                for k in range(first, first + COMMON_FROM):
                    if k:
                        whole = whole & same(x, i + k)
                found = found | whole
            return found

        return _size(F.filter(ordered, inside))

    return _bind(_size(F.filter(words, lambda x: F.lower(x).isin(STOP_WORDS))), lambda listed: F.when(
        listed * 1000 >= F.size(words) * LEAST_COMMON, listed).otherwise(_bind(F.array_sort(words), often)))


def measures(text: Column) -> Column:
    """A struct of all ``MEASURES`` of a text."""
    text = F.coalesce(text, F.lit(""))

    def body(t: Column) -> Column:
        solid = lambda c: F.translate(c, SPACES, "")
        word_part = _bind(words_of(t), lambda w: F.struct(
            _size(w).alias("n_words"),
            repeated_words(w).alias("n_repeat_words"),
            common_words(w).alias("n_common_words")))
        line_part = _bind(lines_of(t), lambda v: F.struct(
            (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines"),
            _size(v).alias("n_lines"),
            _size(F.filter(v, lambda x: F.length(x) < 10)).alias("n_short_lines"),
            _size(F.filter(v, lambda x: F.ltrim(x).substr(1, 1).isin("*", "-", "•"))).alias("n_bullet_lines")))
        return F.struct(
            F.length(solid(t)).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            word_part.alias("w"), line_part.alias("l"))

    def words_of(t):
        return F.filter(F.split(t, SPACE_CLASS + "+"), lambda w: w != "")

    def lines_of(t):
        return F.filter(F.split(t, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)

    return _bind(text, lambda t: _bind(body(t), lambda m: F.struct(
        m["w"]["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"), m["w"]["n_repeat_words"].alias("n_repeat_words"),
        m["w"]["n_common_words"].alias("n_common_words"), m["l"]["n_lines"].alias("n_lines"),
        m["l"]["n_short_lines"].alias("n_short_lines"), m["l"]["n_bullet_lines"].alias("n_bullet_lines"))))


def rule_breaks(rule: Rule, measure) -> Column:
    """Whether the ratio leaves its bounds (integers only) in a row that the rule judges."""
    top, bottom = measure(rule.top) * 1000, measure(rule.bottom)
    broken = F.lit(False)
    if rule.least is not None:
        broken = broken | (top < bottom * rule.least)
    if rule.most is not None:
        broken = broken | (top > bottom * rule.most)
    return (bottom >= rule.from_bottom) & broken


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def assess(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), the measures, ``base_failed``, ``broken`` (names of broken rules) and ``kept``.

    Columns of ``docs`` with the same names as the results are replaced.
    """
    produced = {*MEASURES, "base_failed", "broken", "kept"}
    carried = [c for c in (docs.columns if keep is None else keep) if c not in produced]
    # input columns travel in one struct, so none of their names can meet a name used here
    row = [F.struct(*[_named(c).alias(c) for c in carried]).alias("r")] if carried else []
    measured = docs.select(*row, measures(_named(text_col)).alias("m"))
    get = lambda name: F.col("m")[name]
    base = (get("n_words") < LEAST_WORDS) | (get("n_repeat_words") * 100 > get("n_words") * MOST_REPEATED_PERCENT)
    broken = F.array_compact(F.array(*[F.when(rule_breaks(r, get), F.lit(r.name)) for r in rules]))
    any_broken = F.lit(False)
    for r in rules:
        any_broken = any_broken | rule_breaks(r, get)
    return measured.select(*[F.col("r").getField(c).alias(c) for c in carried], *[get(m).alias(m) for m in MEASURES],
                           base.alias("base_failed"), broken.alias("broken"), (~base & ~any_broken).alias("kept"))


def apply_rules(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The documents that pass, with their own columns."""
    columns = docs.columns
    packed = docs.select(F.struct(*[_named(c).alias(c) for c in columns]).alias("row"), _named(text_col).alias("text"))
    judged = assess(packed, "text", rules, keep=["row"]).where("kept")
    return judged.select(*[F.col("row").getField(c).alias(c) for c in columns])


def rejections(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """(rule, rejected, alone): documents that break each rule, and those that break no other."""
    judged = assess(docs.select(_named(text_col).alias("text")), "text", rules, keep=[])
    reasons = judged.select(F.concat(F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(F.array().cast("array<string>")),
                                     F.col("broken")).alias("reasons"))
    # an inner explode would have the optimizer filter on the reasons, and compute all measures anew in that filter
    each = reasons.select(F.explode_outer("reasons").alias("rule"), (F.size("reasons") == 1).alias("alone"))
    return each.where("rule is not null").groupBy("rule").agg(F.count(F.lit(1)).alias("rejected"), F.count_if("alone").alias("alone"))


def oracle_sql(rules: list[Rule] = RULES) -> str:
    """DuckDB text of the registered query, from the same table."""
    def breaks(r: Rule) -> str:
        sides = []
        if r.least is not None:
            sides.append(f"1000 * {r.top} < {r.least} * {r.bottom}")
        if r.most is not None:
            sides.append(f"1000 * {r.top} > {r.most} * {r.bottom}")
        return f"({r.bottom} >= {r.from_bottom} AND ({' OR '.join(sides)}))"

    space = r"[\x20\x09-\x0D]"
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM texts),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM parts WHERE len(w) >= 3),
windows AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n FROM places),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM windows WHERE n >= 2) GROUP BY doc_id),
often AS (
  SELECT doc_id, sum(n)::BIGINT AS n_often FROM (
    SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM parts) GROUP BY ALL) WHERE n >= {COMMON_FROM} GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '{space}', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({stops})))::BIGINT AS listed, coalesce(n_often, 0) AS n_often, len(l)::BIGINT AS n_lines,
         len(list_filter(l, lambda x: length(x) < 10))::BIGINT AS n_short_lines,
         len(list_filter(l, lambda x: ltrim(x)[1] IN ('*', '-', '•')))::BIGINT AS n_bullet_lines
  FROM parts LEFT JOIN covered USING (doc_id) LEFT JOIN often USING (doc_id)),
measured AS (
  SELECT * EXCLUDE (listed, n_often), CASE WHEN 1000 * listed >= {LEAST_COMMON} * n_words THEN listed ELSE n_often END AS n_common_words FROM counted),
judged AS (
  SELECT *, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words) AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT ({' OR '.join(breaks(r) for r in rules)})) AS kept
FROM judged"""
