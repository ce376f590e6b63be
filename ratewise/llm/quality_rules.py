"""Quality rules kept in a bitmask ledger.

Every rule is evaluated once for each text. The ledger stores what was measured and one
long of failure bits, so a policy, which is a named and versioned set of rules, is a mask:
a document is kept if none of the policy's bits is set. New policies and versions are
applied to a stored ledger without reading a text again, and ablations (what does one rule
alone reject, what would go without it) come from the few distinct bit patterns.

All of it is column functions: texts are never shuffled, measured or joined in Python.
Repeated windows are found from hashes that double their width, (1, 2, 4, 8 words); two
different windows of one text count as equal if their 64-bit hashes are. Work within a
row goes with the length of the text, but for the sort of its windows where some repeat.

Null, empty and blank texts have no words: they fail ``few_words`` and no rule that needs
words. Repeated rows are kept, each with its line in the ledger; a null id is kept. Other
columns of the input are ignored, whatever their names. Empty tables give no rows, and
an ablation of an empty ledger gives a line of zeros for each rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.session import durable

# White space between words, symbols, and the width of repeated windows.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

#: Patterns that the SQL form reads as well.
LETTER = r"[A-Za-z]|[^\x00-\x7F]"
SHOUTED = r"^[^a-z]*[A-Z][^a-z]*\z"
BULLET = r"^[\x20\x09-\x0D]*([-*\x{2022}]|[0-9]+[.)])[\x20\x09-\x0D]"
OPEN_END = r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*\z"

#: What is measured in each text, in the order of the ledger's columns.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_alpha_words", "n_shouted_words", "n_bullet_lines", "n_open_lines", "longest_word",
)


@dataclass(frozen=True)
class Rule:
    """One reason to reject a document: a condition on the measures, as SQL."""

    name: str
    fails: str


#: Bit i of the ledger belongs to rule i. Append only: stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_words", "n_words > 100000"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("few_letters", "100 * n_alpha_words < 70 * n_words"),
    Rule("shouting", "100 * n_shouted_words > 50 * n_words"),
    Rule("bullets", "n_lines > 3 AND 100 * n_bullet_lines > 90 * n_lines"),
    Rule("ellipses", "n_lines > 3 AND 100 * n_open_lines > 30 * n_lines"),
    Rule("endless_word", "longest_word > 1000"),
)


def bit(name: str) -> int:
    """The bit of a rule; unknown names raise."""
    return 1 << [rule.name for rule in RULES].index(name)


@dataclass(frozen=True)
class Policy:
    """A set of rules under a name and a version."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(name) for name in set(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
WEB_1 = Policy("web", 1, (*BASE.rules, "symbols", "repeated_lines", "few_letters"))
#: Length alone is no reason to go: ``many_words`` is measured, but in no policy but this.
SHORT = Policy("short", 1, (*BASE.rules, "many_words"))
WEB = Policy("web", 2, (*WEB_1.rules, "short_words", "long_words", "shouting", "bullets", "ellipses", "endless_word"))
POLICIES = (BASE, SHORT, WEB_1, WEB)


def _joined_hashes(parts: str, apart: int) -> Column:
    """Hash of each part and the one ``apart`` places behind it."""
    pairs = F.greatest(F.size(parts) - apart, F.lit(0))
    return F.zip_with(
        F.slice(parts, F.lit(1), pairs), F.slice(parts, F.lit(apart + 1), pairs), lambda a, b: F.xxhash64(a, b)
    )


def _repeated_places(windows: str) -> Column:
    """(hash, place) of all windows in the order of their hashes, none if all differ."""
    numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    same = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(same, none).otherwise(F.sort_array(numbered))


def _starts(ordered: str) -> Column:
    """Places, ascending, of windows that occur twice or more."""
    column = F.col(ordered)

    def shared(window: Column, i: Column) -> Column:
        before = F.get(column, i - 1)["h"].eqNullSafe(window["h"])
        return before | F.get(column, i + 1)["h"].eqNullSafe(window["h"])

    return F.sort_array(F.filter(column, shared)["i"])


def _covered(starts: str) -> Column:
    """Words in windows that begin at the places."""
    column = F.col(starts)
    widths = F.transform(
        column, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(column, i + 1) - at, F.lit(WINDOW)))
    )
    return F.aggregate(widths, F.lit(0), lambda total, width: total + width)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row of ``docs`` (doc_id, text).

    ``n_lines`` counts lines that hold a word, ``n_dup_lines`` those equal to an earlier
    one, ``n_repeat_words`` words in windows of eight that the text holds twice or more.
    Letters are those of ASCII and all characters beyond; a shouted word has a capital of
    ASCII, none of its small letters, and two characters at least.
    """
    text = F.coalesce("text", F.lit(""))
    spaced = docs.select("doc_id", text.alias("whole"), F.regexp_extract_all(text, F.lit(WORD), 0).alias("words"))
    lines = F.filter(F.split("whole", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    hashed = spaced.select("*", lines.alias("lines"), _joined_hashes("words", 1).alias("two"))
    hashed = hashed.withColumn("four", _joined_hashes("two", 2)).withColumn("windows", _joined_hashes("four", 4))
    placed = hashed.drop("two", "four").withColumn("ordered", _repeated_places("windows"))
    placed = placed.drop("windows").withColumn("starts", _starts("ordered")).drop("ordered")

    def count(array: str, holds: Column) -> Column:
        return F.size(F.filter(array, lambda x: holds(x)))

    measures = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.regexp_count("whole", F.lit(SYMBOLS)),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _covered("starts"),
        "n_lines": F.size("lines"),
        "n_alpha_words": count("words", lambda w: w.rlike(LETTER)),
        "n_shouted_words": count("words", lambda w: (F.length(w) > 1) & w.rlike(SHOUTED)),
        "n_bullet_lines": count("lines", lambda x: x.rlike(BULLET)),
        "n_open_lines": count("lines", lambda x: x.rlike(OPEN_END)),
        "longest_word": F.coalesce(F.array_max(F.transform("words", F.length)), F.lit(0)),
    }
    return placed.select("doc_id", *[measures[name].cast("long").alias(name) for name in MEASURES])


def evaluated(docs: DataFrame) -> DataFrame:
    """The measures of every row and ``failures``, the bits of all rules it fails."""
    failed = [F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES)]
    bits = failed[0]
    for other in failed[1:]:
        bits = bits.bitwiseOR(other)
    return measured(docs).withColumn("failures", bits.cast("long"))


def ledger(docs: DataFrame) -> DataFrame:
    """The evaluated rows, stored in the work folder.

    Only a stored ledger keeps a later filter on its columns from being moved down to the
    texts, where every rule would be evaluated anew for it.
    """
    return durable(evaluated(docs), "rule-ledger")


def passes(policy: Policy, failures: str = "failures") -> Column:
    """Whether a line of a ledger has none of the policy's bits."""
    return F.col(failures).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def verdicts(lines: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """A stored ledger with one boolean ``<name>_<version>`` for each policy."""
    return lines.select("*", *[passes(p).alias(f"{p.name}_{p.version}") for p in policies])


def patterns(lines: DataFrame, *groups: str) -> DataFrame:
    """How many lines of a ledger, by group, have each pattern of bits.

    There are as many rows as patterns occur, whatever the number of documents; they are
    added up per task before the shuffle.
    """
    return lines.groupBy(*groups, "failures").agg(F.count(F.lit(1)).alias("documents"))


def ablation(lines: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """For each policy and each of its rules: documents, how many the policy keeps, how many
    fail the rule, how many fail it alone (so many more are kept without it), and how many
    would be rejected by the rule alone as a policy of its own yet are kept by the others.
    """
    rules = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(name).alias("rule"),
                F.lit(p.mask).cast("long").alias("mask"), F.lit(bit(name)).cast("long").alias("bit"),
            )
            for p in policies for name in p.rules
        ]
    )
    spark = lines.sparkSession
    wanted = spark.range(1).select(F.inline(rules))
    named = ["policy", "version", "rule"]
    counted = patterns(lines).select("failures", "documents", F.inline(rules))
    set_ = F.col("failures").bitwiseAND(F.col("bit")) != 0
    rest = F.col("failures").bitwiseAND(F.col("mask").bitwiseXOR(F.col("bit"))) == 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("documents")).otherwise(0))

    sums = counted.groupBy(*named).agg(
        F.sum("documents").alias("documents"),
        total(~set_ & rest).alias("kept"),
        total(set_).alias("failed"),
        total(set_ & rest).alias("failed_alone"),
        total(rest).alias("kept_without"),
    )
    figures = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in sums.columns[3:]]
    return wanted.select(*named).join(sums, named, "left").select(*named, *figures)


def fingerprints(lines: DataFrame, *groups: str) -> DataFrame:
    """By group: documents, the bits that any of them fails and the bits that all fail."""
    return patterns(lines, *groups).groupBy(*groups).agg(
        F.sum("documents").alias("documents"),
        F.bit_or("failures").alias("any_fails"),
        F.bit_and("failures").alias("all_fail"),
    )


def moved(lines: DataFrame, old: Policy, new: Policy) -> DataFrame:
    """How many documents change sides from one policy to another, by pattern of the bits
    that decide it: the rules in one of the two policies only."""
    both = patterns(lines).select("documents", F.col("failures"), passes(old).alias("before"), passes(new).alias("after"))
    deciding = F.col("failures").bitwiseAND(F.lit(old.mask | new.mask).cast("long"))
    return (
        both.where("before != after")
        .groupBy("before", "after", deciding.alias("failures"))
        .agg(F.sum("documents").alias("documents"))
    )
