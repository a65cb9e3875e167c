"""Quality rules whose thresholds follow the corpus, in DataFrame operations only.

1. Each text is measured once: counts of words, characters, symbols, lines and
   repeats (``measured``).
2. Every measure is sketched per (language, source) as counts per logarithmic
   bucket: a value keeps its ``SKETCH_BITS`` leading binary digits, so a quantile
   is off by at most one part in 2**(SKETCH_BITS - 1).  Sketches are plain rows of
   counts; merging them is adding them up, in any order and to the same result.
   A group with under ``min_rows`` documents takes the merged sketch of its
   language, a language with too few the merged sketch of all.
3. A limit is the median and so many times the spread on the *other* side of it
   (10th percentile to median for an upper limit, median to 90th for a lower
   one): a group in which less than half of the documents are bad cannot
   raise its own limits by them.
4. The limits (one row per language and source) are joined to the measures.

Only numbers are shuffled, after map-side counting; a source that holds a third of
all rows is one row per bucket and task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripscope.llm.common import WORD, table, written

SKETCH_BITS = 7
#: Documents that a group needs for limits of its own.
MIN_ROWS = 100
#: How many spreads from the median a limit lies.
REACH = 6
# Base rules: fixed values of the contract.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


@dataclass(frozen=True)
class Rule:
    """A measure (a whole number per document, 0 or more), the least spread its
    limits are built with, and the sides on which it is limited."""

    name: str
    value: str
    floor: int
    upper: bool = True
    lower: bool = False


#: In thousandths; documents without words fail the base rules anyway.
RULES = (
    Rule("symbols", "n_symbols * 1000 div greatest(n_words, 1)", 20),
    Rule("word_length", "word_chars * 1000 div greatest(n_words, 1)", 300, lower=True),
    Rule("duplicate_lines", "n_dup_lines * 1000 div greatest(n_lines, 1)", 100),
    Rule("repeats", "n_repeat_words * 1000 div greatest(n_words, 1)", 75),
)


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeats(words: str) -> str:
    """Number of words that lie in three-word windows found twice or more.
    Windows are compared by 64-bit hashes within one text; most texts repeat
    none and are not sorted."""
    hashes = f"transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))"
    same = "coalesce(get(s, j - 1).h = s[j].h, false) or coalesce(get(s, j + 1).h = s[j].h, false)"
    found = f"transform(filter(sequence(0, size(s) - 1), j -> {same}), j -> s[j].i)"
    covered = f"size(array_distinct(flatten(transform({found}, p -> array(p, p + 1, p + 2)))))"
    placed = "sort_array(transform(h, (x, i) -> named_struct('h', x, 'i', i)))"
    counted = f"if(size(array_distinct(h)) = size(h), 0, {_let('s', placed, covered)})"
    return f"if(size({words}) < 4, 0, {_let('h', hashes, counted)})"


def measured(docs: DataFrame, *, text: str = "text", by: Sequence[str] = ("lang", "source"), key: str = "doc_id") -> DataFrame:
    """key, the columns ``by`` and the counts of each whole text: n_words,
    word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words.
    A NULL text has none.  No shuffle; other columns are ignored, whatever
    their names; a text is held as its list of words."""
    word = WORD.replace("\\", "\\\\")
    line = "[^\\\\x20\\\\x09-\\\\x0D]"
    of_words = (
        "named_struct('n_words', size(w), 'word_chars', char_length(array_join(w, '')), "
        f"'n_repeat_words', {_repeats('w')})"
    )
    of_lines = "named_struct('n_lines', size(l), 'n_dup_lines', size(l) - size(array_distinct(l)))"
    return (
        docs.select(
            F.col(key).alias("key"), *[F.col(c).alias(f"by{i}") for i, c in enumerate(by)],
            F.coalesce(F.col(text), F.lit("")).alias("t"),
        )
        .select(
            "key", *[f"by{i}" for i in range(len(by))],
            F.expr(_let("w", f"regexp_extract_all(t, '{word}', 0)", of_words)).alias("w"),
            F.expr(_let("l", f"filter(split(t, '\\n'), x -> x rlike '{line}')", of_lines)).alias("l"),
            F.regexp_count("t", F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        )
        .select(
            "key", *[f"by{i}" for i in range(len(by))],
            *[
                F.col(c).cast("long").alias(c.split(".")[-1])
                for c in ("w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")
            ],
        )
    )


def sketch_bucket(value: Column, bits: int = SKETCH_BITS) -> Column:
    """The lower end of a value's bucket: its leading ``bits`` binary digits."""
    dropped = F.greatest(F.length(F.bin(value)) - bits, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, dropped), dropped)


def sketched(df: DataFrame, by: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Quantile sketches: by, measure, bucket, n.  Values below 0 count as 0,
    NULL values not at all."""
    pairs = [F.struct(F.lit(m).alias("measure"), v.cast("long").alias("value")) for m, v in values.items()]
    return (
        df.select(*by, F.explode(F.array(*pairs)).alias("one"))
        .where("one.value is not null")
        .groupBy(*by, F.col("one.measure").alias("measure"), sketch_bucket(F.greatest("one.value", F.lit(0))).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketches: Iterable[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Sketches added up, per group of ``by`` (sketches of separate tables, or
    of finer groups)."""
    return reduce(DataFrame.unionByName, sketches).groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, by: Sequence[str], percents: Sequence[int]) -> DataFrame:
    """by, measure, total and p<percent> per group: the first bucket that at
    least so many per cent of the values reach or fall short of.  A group has
    few rows (at most 2**bits per power of two), so its window is small."""
    groups = [*by, "measure"]
    upto = Window.partitionBy(*groups).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*groups)
    return (
        sketch.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total"))
        .groupBy(*groups)
        .agg(
            F.max("total").alias("total"),
            *[F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, F.col("bucket"))).alias(f"p{p}") for p in percents],
        )
    )


def adaptive_limits(
    sketch: DataFrame, by: Sequence[str], rules: Sequence[Rule] = RULES, *, reach: int = REACH, min_rows: int = MIN_ROWS
) -> DataFrame:
    """One row per group of ``by`` (its last column the finest): for each rule
    low_<name> and high_<name> (NULL: no limit), from the group's own sketch or,
    below ``min_rows``, from that of the next coarser group that has enough
    (of all, if none has)."""
    levels = [list(by[:k]) for k in range(len(by), -1, -1)]
    limits = sketch.select(*by, "measure").distinct()
    for k, level in enumerate(levels):
        q = sketch_quantiles(merged([sketch], level), level, (10, 50, 90)).select(
            *[F.col(c).alias(f"k{i}") for i, c in enumerate(level)], F.col("measure").alias("of"),
            F.struct("total", "p10", "p50", "p90").alias(f"level{k}"),
        )
        same = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"k{i}")) for i, c in enumerate(level)], F.col("measure") == F.col("of")
        )
        limits = limits.join(q, same).drop("of", *[f"k{i}" for i in range(len(level))])
    names = [f"level{k}" for k in range(len(levels))]
    chosen = F.coalesce(*[F.when(F.col(f"{n}.total") >= min_rows, F.col(n)) for n in names[:-1]], F.col(names[-1]))
    limits = limits.select(*by, "measure", chosen.alias("q"))

    def limit(rule: Rule, upper: bool) -> Column:
        spread = F.col("q.p50") - F.col("q.p10") if upper else F.col("q.p90") - F.col("q.p50")
        off = F.greatest(spread, F.lit(rule.floor)) * reach
        value = F.col("q.p50") + off if upper else F.col("q.p50") - off
        return F.max(F.when(F.col("measure") == rule.name, value))

    return limits.groupBy(*by).agg(
        *[limit(r, False).alias(f"low_{r.name}") for r in rules if r.lower],
        *[limit(r, True).alias(f"high_{r.name}") for r in rules if r.upper],
    )


def judge(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", by: Sequence[str] = ("lang", "source"),
    rules: Sequence[Rule] = RULES, reach: int = REACH, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: key, the counts of ``measured``,
    base_failed, failed (names of the adaptive rules that the document breaks) and kept.

    NULL and empty texts have no words and fail the base rules.  NULL languages
    and sources are groups of their own.  Repeated rows count as often as they
    stand and get the same verdict.  An empty table gives an empty result.
    Limits are of all documents, those that fail the base rules included.
    """
    rows = written(measured(docs, text=text, by=by, key=key), "rules-measured")
    names = [f"by{i}" for i in range(len(by))]
    values = {r.name: F.expr(r.value) for r in rules}
    sketch = written(sketched(rows, names, values), "rules-sketch")
    limits = written(adaptive_limits(sketch, names, rules, reach=reach, min_rows=min_rows), "rules-limits")
    limits = limits.withColumnsRenamed({n: f"limit_{n}" for n in names})
    # One short row per language and source; the planner sees its size.
    joined = rows.join(limits, reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"limit_{n}")) for n in names]), "left")
    breaks = [
        F.when(
            reduce(
                lambda a, b: a | b,
                ([values[r.name] > F.col(f"high_{r.name}")] if r.upper else [])
                + ([values[r.name] < F.col(f"low_{r.name}")] if r.lower else []),
            ),
            F.lit(r.name),
        )
        for r in rules
    ]
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return (
        joined.select("*", base.alias("base_failed"), F.array_compact(F.array(*breaks)).alias("failed"))
        .select(
            F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "base_failed", "failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
        )
    )


def op13_adaptive_rules(spark, sf_dir):
    judged = judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# The same rules over DuckDB lists; parameters from above.
OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
m AS (
  SELECT w.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(list_aggregate(w || [''], 'string_agg', ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov ON w.r = cov.r),
v AS (
  SELECT *, n_symbols * 1000 // greatest(n_words, 1) AS symbols, word_chars * 1000 // greatest(n_words, 1) AS word_length,
         n_dup_lines * 1000 // greatest(n_lines, 1) AS duplicate_lines, n_repeat_words * 1000 // greatest(n_words, 1) AS repeats
  FROM m),
u AS (
  SELECT lang, source, measure, value, greatest(length(bin(value)) - {SKETCH_BITS}, 0) AS e
  FROM v UNPIVOT (value FOR measure IN (symbols, word_length, duplicate_lines, repeats))),
s AS (SELECT lang, source, measure, (value >> e) << e AS bucket, count(*) AS n FROM u GROUP BY ALL),
g AS (
  SELECT 0 AS level, lang, source, measure, bucket, n FROM s
  UNION ALL SELECT 1, lang, NULL, measure, bucket, sum(n) FROM s GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, measure, bucket, sum(n) FROM s GROUP BY ALL),
c AS (
  SELECT *, sum(n) OVER (k ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER k AS total
  FROM g WINDOW k AS (PARTITION BY level, lang, source, measure)),
q AS (
  SELECT level, lang, source, measure, max(total) AS total, min(bucket) FILTER (upto * 100 >= total * 10) AS p10,
         min(bucket) FILTER (upto * 100 >= total * 50) AS p50, min(bucket) FILTER (upto * 100 >= total * 90) AS p90
  FROM c GROUP BY ALL),
pick AS (
  SELECT k.lang, k.source, k.measure, q.p10, q.p50, q.p90,
         row_number() OVER (PARTITION BY k.lang, k.source, k.measure ORDER BY q.level) AS choice
  FROM (SELECT DISTINCT lang, source, measure FROM s) k JOIN q ON k.measure = q.measure
   AND (q.level = 2 OR k.lang IS NOT DISTINCT FROM q.lang) AND (q.level > 0 OR k.source IS NOT DISTINCT FROM q.source)
   AND (q.level = 2 OR q.total >= {MIN_ROWS})),
lim AS (
  SELECT lang, source, {", ".join(
    f"max(p50 + {REACH} * greatest(p50 - p10, {r.floor})) FILTER (measure = '{r.name}') AS high_{r.name}, "
    f"max(p50 - {REACH} * greatest(p90 - p50, {r.floor})) FILTER (measure = '{r.name}') AS low_{r.name}" for r in RULES)}
  FROM pick WHERE choice = 1 GROUP BY ALL),
f AS (
  SELECT v.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         {" OR ".join([f"{r.name} > high_{r.name}" for r in RULES if r.upper] + [f"{r.name} < low_{r.name}" for r in RULES if r.lower])} AS broken
  FROM v JOIN lim ON v.lang IS NOT DISTINCT FROM lim.lang AND v.source IS NOT DISTINCT FROM lim.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT broken AS kept FROM f
"""
