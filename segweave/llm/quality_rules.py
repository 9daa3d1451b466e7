"""Quality rules as a bitmask ledger, in DataFrame expressions alone.

`ledger` measures each whole text once and stores the measurements and a word
of failure bits, one for each rule. A policy is a named version that says
which bits reject a document; `verdicts` applies one, `ablation` counts by
bitwise aggregation what each rule rejects, alone or at all, so that policies
are compared without reading a text again.

Words are runs of other characters than space and U+0009-U+000D. Null and
empty texts have no words and fail the base rules. Rows are judged each on its
own (equal ids or texts stay separate rows), an empty table gives no row, and
extra columns are carried along by `ledger` only if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Words in repeated 3-word windows are found inside the row, without a
    shuffle: each window's hash and position share a long (position in the low
    20 bits), sorting those brings equal windows together, and neighbours count
    as equal only if their words are equal. Where different windows meet under the
    same high bits, which sorting on them can't tell apart, the windows themselves are sorted.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    first = docs.select(
        *keep,
        F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "").alias("_w"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    n = F.size("_w").cast("long")
    low = (1 << 20) - 1
    windows = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).bitwiseAND(~low).bitwiseOR(i.cast("long") % (low + 1))),
    )
    second = first.select(
        *keep,
        "_w",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.coalesce(windows, F.array().cast("array<long>"))).alias("_s"),
    )
    passed = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    meets = lambda i: F.get("_s", i).bitwiseAND(~low) == F.get("_s", i - 1).bitwiseAND(~low)
    close = F.when(F.size("_s") > 1, F.filter(F.sequence(F.lit(1), F.size("_s") - 1), meets)).otherwise(F.array().cast("array<int>"))
    third = second.select(*passed, "_w", "_s", close.alias("_c"))
    # an id that is never negative: filters on the result stay above it, or the optimizer would copy all of the above into them
    repeats = F.when((F.size("_c") == 0) | (F.monotonically_increasing_id() < 0), F.lit(0).cast("long")).otherwise(_repeated(low))
    return third.select(*passed, repeats.alias("n_repeat_words"))


def _held(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(marks: Column) -> Column:
    """Words that windows starting at the sorted positions cover."""
    steps = F.transform(marks, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(marks, k + 1) - p, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _starts(pairs: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(pairs)))


def _repeated(low: int) -> Column:
    """Words in repeated windows, from the sorted hashes `_s`, the places `_c` where neighbours meet and the words `_w`."""

    def at(i):
        return F.get("_s", i).bitwiseAND(low).cast("int")

    def differ(i):
        p, q = at(i), at(i - 1)
        return (F.get("_w", p) != F.get("_w", q)) | (F.get("_w", p + 1) != F.get("_w", q + 1)) | (F.get("_w", p + 2) != F.get("_w", q + 2))

    clash = F.exists("_c", differ) | (F.size("_s") > low)
    by_hash = _starts(F.transform("_c", lambda i: F.array(at(i - 1), at(i))))
    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.struct(F.get("_w", i).alias("a"), F.get("_w", i + 1).alias("b"), F.get("_w", i + 2).alias("c"), i.alias("i"))))

    def by_words(e):
        equal = lambda i: F.struct(F.get(e, i)["a"], F.get(e, i)["b"], F.get(e, i)["c"]) == F.struct(F.get(e, i - 1)["a"], F.get(e, i - 1)["b"], F.get(e, i - 1)["c"])
        return _starts(F.transform(F.filter(F.sequence(F.lit(1), F.size(e) - 1), equal), lambda i: F.array(F.get(e, i - 1)["i"], F.get(e, i)["i"])))

    return F.when(clash, _held(_held(windows, by_words), _covered)).otherwise(_held(by_hash, _covered))


#: Bit, name and failing condition of each rule; conditions are in whole numbers where the base fixes them.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("many_words", "n_words > 200000"),
    ("short_mean_word", "word_chars < 2 * n_words"),
    ("long_mean_word", "word_chars > 15 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
]
#: Policy versions: the rules that reject.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "many_words", "short_mean_word", "long_mean_word", "many_symbols", "duplicate_lines"],
    "v1_lenient": ["few_words", "repeated_windows", "short_mean_word", "long_mean_word"],
}


def mask(names: list[str]) -> int:
    known = [name for name, _ in RULES]
    return sum(1 << known.index(n) for n in set(names))


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, the measurements, and failed_bits: bit k is set if rule k fails."""
    m = measured(docs, list(keep))
    bits = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)), F.lit(0))
    return m.withColumn("failed_bits", bits.cast("long"))


def verdicts(book: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with base_failed and kept under the policy; the base rules reject under any."""
    failed = lambda names: F.col("failed_bits").bitwiseAND(F.lit(mask(names))) != 0
    return book.withColumn("base_failed", failed(POLICIES["base"])).withColumn("kept", ~failed(POLICIES["base"] + POLICIES[policy]))


def ablation(book: DataFrame, policy: str = "v1") -> DataFrame:
    """One row a rule of the policy: failing documents, those that only it rejects, and what is kept without it.

    The ledger shrinks to a count for each distinct word of bits, 2 to the
    number of rules at most, before rules are compared.
    """
    whole = mask(POLICIES[policy])
    words = book.groupBy(F.col("failed_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count(F.lit(1)).alias("docs"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for k, (name, _) in enumerate(RULES) if name in POLICIES[policy]])
    each = words.withColumn("r", F.explode(rules)).select("docs", "bits", "r.rule", "r.bit")
    total = lambda when: F.sum(F.when(when, F.col("docs")).otherwise(0)).alias
    hit, rest = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    return each.groupBy("rule").agg(total(hit)("failing"), total(hit & (rest == 0))("only_this"), total(rest == 0)("kept_without"), F.bit_or("bits").alias("seen_bits"))


def quality_rules(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_bits."""
    judged = verdicts(ledger(docs), policy)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits")
