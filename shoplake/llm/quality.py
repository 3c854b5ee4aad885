"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps its measurements and one bit per failed rule. Versioned policies are
masks over those bits, so a policy, a change of policy or an ablation is an AND and a count over the ledger, never
another pass over the texts. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

#: Rules by bit: a name, and when a document fails, in terms of the measurements. A bit's meaning never changes; new rules get new bits.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("long_words", "word_chars > 12 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("shouting", "2 * n_upper > word_chars"),
    ("few_letters", "10 * n_letter_words < 7 * n_words"),
)
BITS = {name: 1 << k for k, (name, _) in enumerate(RULES)}
BASE = BITS["too_few_words"] | BITS["repeated_windows"]

#: Policies by version: the rules that reject a document. Versions are only added.
POLICIES: dict[str, int] = {
    "base-1": BASE,
    "strict-1": BASE | BITS["many_symbols"] | BITS["repeated_lines"] | BITS["long_words"] | BITS["short_words"] | BITS["few_letters"],
    "strict-2": sum(BITS.values()),
}
CURRENT = "strict-2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letter_words")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda done, x: done + x)


def _repeat_words(words: Column) -> Column:
    """Words inside windows that the text has twice or more.

    Windows are hashed; where all differ, as in most texts, that is all. Otherwise hashes are sorted with their places, equal
    neighbours are marked, and the marked windows' union is measured from one place to the next.
    """
    n_windows = F.size(words) - (WINDOW - 1)
    hashed = F.transform(F.sequence(F.lit(0), n_windows - 1), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def equal(pair: Column, other: Column) -> Column:
            return F.coalesce(pair["h"] == other["h"], F.lit(False))

        twice = _let(placed, lambda p: F.filter(p, lambda x, j: equal(x, F.get(p, j - 1)) | equal(x, F.get(p, j + 1))))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return _let(places, lambda d: _total(F.transform(d, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(d, j + 1) - x, F.lit(WINDOW))).cast("long"))))

    some = _let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    return F.when(n_windows < 2, F.lit(0).cast("long")).otherwise(some)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements (``MEASURES``, all long) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def count(values: Column) -> Column:
        return F.size(values).cast("long")

    of_words = _let(
        words,
        lambda w: F.struct(
            count(w).alias("n_words"),
            _total(F.transform(w, F.char_length)).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            count(F.filter(w, lambda x: x.rlike(r"\p{L}"))).alias("n_letter_words"),
        ),
    )
    of_lines = _let(lines, lambda x: F.struct(count(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        of_words.alias("w"),
        of_lines.alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    )
    return found.select("doc_id", "w.*", "l.*", "n_symbols", "n_upper").select("doc_id", *MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: bit k is set if rule k of ``RULES`` rejects the document.

    ``docs`` needs doc_id and text; other columns are not read. A NULL text has no words. Words are what white space (blank,
    \\x09-\\x0D) parts, however long. A window is compared by a 64-bit hash. Repeated rows each come back. An empty table
    gives no rows.
    """
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured(docs).withColumn("failed", failed.cast("long"))


def judged(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with base_failed and the policy's verdict ``kept``."""
    mask = POLICIES[policy]
    return entries.withColumns(
        {
            "base_failed": F.col("failed").bitwiseAND(F.lit(BASE)) != 0,
            "kept": F.col("failed").bitwiseAND(F.lit(BASE | mask)) == 0,
            "policy": F.lit(policy),
        }
    )


def ablations(entries: DataFrame, policies: dict[str, int] | None = None) -> DataFrame:
    """For each policy and rule of it: documents, those rejected, those the rule rejects, and those that only it rejects.

    The ledger is first counted by failure bits (at most 2**rules rows, summed before the shuffle); all else is bit arithmetic on
    those counts. ``only_rule`` is what dropping the rule would let back in.
    """
    counts = entries.groupBy("failed").agg(F.count("*").alias("n"))
    cases = [F.struct(F.lit(p).alias("policy"), F.lit(mask).alias("mask"), F.lit(name).alias("rule"), F.lit(bit).alias("bit")) for p, mask in (policies or POLICIES).items() for name, bit in BITS.items() if mask & bit]
    each = counts.select("failed", "n", F.explode(F.array(*cases)).alias("c")).select("n", "c.*", F.col("failed").bitwiseAND(F.col("c.mask")).alias("hit"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("documents"),
        total(F.col("hit") != 0).alias("rejected"),
        total(F.col("hit").bitwiseAND(F.col("bit")) != 0).alias("by_rule"),
        total(F.col("hit") == F.col("bit")).alias("only_rule"),
    )


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT r, i, words[i:i+4] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM dup) GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
      CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
      CAST(len(regexp_extract_all(t, '\p{Lu}')) AS BIGINT) AS n_upper,
      CAST(len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS BIGINT) AS n_letter_words FROM w LEFT JOIN cov USING (r)),
f AS (SELECT *, CAST(
      CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 12 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END + CASE WHEN 10 * n_letter_words < 7 * n_words THEN 128 ELSE 0 END AS BIGINT) AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed & 255 = 0 AS kept, 'strict-2' AS policy FROM f
"""
