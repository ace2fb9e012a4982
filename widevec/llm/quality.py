"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document and leaves a bit and its measurement. A policy is
a name, a version and a mask, so that another policy, or the question what a rule costs,
needs the ledger alone and no text.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from widevec.llm.common import table

# The white space that separates words, and the characters counted as symbols: fixed values.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

# Rules in the order of their bits, as SQL over the measurements: true where a document fails.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbol_heavy": "n_symbols > 2 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}
BASE_RULES = ("few_words", "repeated_words")


def mask_of(names, rules=RULES):
    order = list(rules)
    return sum(1 << order.index(name) for name in names)


@dataclass(frozen=True)
class Policy:
    """Which failures reject a document."""

    name: str
    version: int
    mask: int


STANDARD = Policy("standard", 1, mask_of(RULES))
BASE = Policy("base", 1, mask_of(BASE_RULES))


def measured(df, text="text"):
    """``df`` with the measurements of its texts, replacing columns of the same names.

    Null and empty texts have no words and measure 0 throughout. Whole texts are measured,
    by SQL expressions alone: shuffles nothing.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bare = F.btrim(content, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+"))
    lines = F.filter(F.split(content, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    found = df.withColumns({"q_words": words, "q_lines": lines})
    n_words = F.size("q_words")
    hashes = F.when(
        n_words >= 3,
        F.transform(
            F.sequence(F.lit(0), n_words - 3),
            lambda i: F.xxhash64(*[F.get("q_words", i + k) for k in range(3)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    found = found.withColumn("q_windows", hashes)
    found = found.withColumns(
        {
            "n_words": n_words.cast("long"),
            "word_chars": F.length(F.array_join("q_words", "")).cast("long"),
            "n_symbols": F.regexp_count(content, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "n_lines": F.size("q_lines").cast("long"),
            "n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
        }
    )
    return _with_repeats(found).drop("q_words", "q_lines", "q_windows")


def _with_repeats(found):
    """Adds how many words lie in a window found twice. Equal windows meet by sorting, so a
    long text of many repeats costs no more than its length times its logarithm. Each step
    is a column of its own, since an expression inside a lambda is evaluated per element."""
    windows = F.col("q_windows")
    once = F.size(windows) == F.size(F.array_distinct(windows))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = found.withColumn("q_placed", F.when(once, nothing).otherwise(placed))
    meets = lambda x, k: (x["h"] == F.get("q_placed", k)["h"]).eqNullSafe(True)
    twice = F.filter("q_placed", lambda x, k: meets(x, k - 1) | meets(x, k + 1))
    found = found.withColumn("q_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # From left to right: how many words are covered, and where the cover ends.
    covered = F.aggregate(
        "q_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct(
            (a["n"] + i + 3 - F.greatest(a["end"], i)).cast("long").alias("n"), (i + 3).alias("end")
        ),
        lambda a: a["n"],
    )
    return found.withColumn("n_repeat_words", covered).drop("q_placed", "q_starts")


def ledger(df, text="text", rules=RULES):
    """``df`` with its measurements and ``fail_bits`` (long), a bit per failed rule."""
    bits = [F.when(F.expr(failed), F.lit(1 << at)).otherwise(F.lit(0)) for at, failed in enumerate(rules.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    # A filter on the bits must not be pushed down into the measurements, where each lambda
    # would evaluate them again per element; it is not pushed past what depends on the row's place.
    placed = F.monotonically_increasing_id() >= 0
    return measured(df, text).withColumn("fail_bits", F.when(placed, total.cast("long")))


def passes(policy):
    """True where the ledger's bits reject nothing under the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0


def ablations(found, policy, rules=RULES):
    """A row per rule of the policy: how many documents fail it, and how many it alone rejects.

    One aggregate of a few numbers over the ledger.
    """
    bits = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    asked = [(name, 1 << at) for at, name in enumerate(rules) if policy.mask >> at & 1]
    sums = []
    for name, bit in asked:
        failed, alone = bits.bitwiseAND(F.lit(bit)) != 0, bits == bit
        sums += [F.count_if(failed).alias(f"f_{name}"), F.count_if(alone).alias(f"a_{name}")]
    totals = found.agg(*sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(policy.name).alias("policy"),
                F.lit(policy.version).alias("version"),
                F.lit(name).alias("rule"),
                F.col(f"f_{name}").alias("failed"),
                F.col(f"a_{name}").alias("only_by_it"),
            )
            for name, _ in asked
        ]
    )
    return totals.select(F.inline(rows))


def keep_good(df, policy=STANDARD, text="text"):
    """The rows of ``df``, with their own columns, that the policy does not reject."""
    kept = ledger(df.select(F.col(text).alias("q_text"), F.struct(*[F.col(c) for c in df.columns]).alias("q_row")), "q_text")
    return kept.filter(passes(policy)).select("q_row.*")


def op8_quality_ledger(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ledger(docs).select(
        "doc_id",
        *[m for m in MEASURES if m != "n_lines"],
        (F.col("fail_bits").bitwiseAND(F.lit(BASE.mask)) != 0).alias("base_failed"),
        passes(STANDARD).alias("kept"),
        "fail_bits",
    )


OP8_SQL = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT r, words, unnest(range(1, CAST(len(words) AS BIGINT) - 1)) AS i FROM split)),
twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS t(k) GROUP BY r),
measures AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM split LEFT JOIN covered USING (r)),
bits AS (
    SELECT *, CAST(
        (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN n_symbols > 2 * n_words THEN 4 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars > 25 * n_words THEN 16 ELSE 0 END)
        + (CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits
    FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM bits"""
