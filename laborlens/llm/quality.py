"""Quality rules as a ledger of failure bits, on Spark expressions alone.

Every rule is evaluated once for every document. The ledger holds its measurements and one bit for each rule that it
fails. A policy is a version with masks over these bits, so policies are applied, compared and changed on the ledger
without a look at the texts, and ablations are bit operations on the few distinct patterns of failures.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import UPPER, other_columns

#: White space between words, and the characters counted as symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window that counts as repeated where it stands twice.
WINDOW = 3

#: Rules in the order of their bits: name and the SQL condition on the measurements under which a document fails.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_dup_lines > 0 AND 2 * n_dup_lines >= n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "upper_case": "2 * n_upper > word_chars",
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words"]


def bits(*names: str) -> int:
    """The mask of the named rules."""
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


@dataclass(frozen=True)
class Policy:
    """A version of the decision: one failure among ``hard`` rejects, and ``least`` failures among ``soft`` do."""

    version: str
    hard: int
    soft: int = 0
    least: int = 2

    def rejects(self, failures: Column) -> Column:
        some = failures.bitwiseAND(F.lit(self.hard).cast("bigint")) != 0
        return some | (F.bit_count(failures.bitwiseAND(F.lit(self.soft).cast("bigint"))) >= self.least)


#: What every policy holds on to.
BASE = bits("few_words", "repeated_words")
POLICIES = [
    Policy("v1", BASE | bits("symbols", "repeated_lines")),
    Policy("v2", BASE | bits("symbols", "repeated_lines", "upper_case"), soft=bits("short_words", "long_words"), least=1),
]


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(places: Column) -> Column:
    """Words in windows that begin at these sorted places."""
    steps = F.transform(places, lambda p, k: F.coalesce(F.least(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def _repeated(words: Column) -> Column:
    """Words in windows that stand twice or more: the windows are sorted, equal ones are neighbours then."""
    def window(i: Column) -> Column:
        parts = [F.get(words, i + j) for j in range(WINDOW)]
        return F.struct(F.concat_ws(" ", *parts).alias("text"), i.alias("place"))

    def twice(ordered: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce((F.get(ordered, k - 1)["text"] == x["text"]) | (F.get(ordered, k + 1)["text"] == x["text"]),
                              F.get(ordered, k - 1)["text"] == x["text"], F.get(ordered, k + 1)["text"] == x["text"], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, same), lambda x: x["place"]))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)
    covered = _once(_once(F.sort_array(windows), twice), _covered)
    return F.when(F.size(words) > WINDOW, covered).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the measurements that the rules ask for; each text is split once."""
    whole = F.coalesce(F.col(text), F.lit(""))
    letters = F.translate(whole, SPACE, "")
    kept = other_columns(docs, MEASURES)
    split = docs.select(
        F.struct(*kept).alias("_row"), F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"), letters.alias("_letters"))
    without = {name: F.length("_letters") - F.length(F.translate("_letters", gone, "")) for name, gone in (("n_symbols", SYMBOLS), ("n_upper", UPPER))}
    found = {
        "n_words": F.size("_words"), "word_chars": F.length("_letters"), **without, "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")), "n_repeat_words": _once(F.col("_words"), _repeated),
    }
    return split.select(*(F.col("_row")[c].alias(c) for c in kept), *(found[m].cast("bigint").alias(m) for m in MEASURES))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row for every row of ``docs``: its columns, the measurements and ``failures``, bit i set where rule i fails.

    Words stand between ASCII white space, whole texts are read. A null text has no words, as an empty one has, and
    fails ``few_words`` alone. Repeated rows and rows without id are rows like any other; an empty table gives none.
    Columns of ``docs`` with the name of a measurement or ``failures`` are replaced. No row leaves its partition.
    """
    failures = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(0).cast("bigint") for i, condition in enumerate(RULES.values())]
    total = failures[0]
    for one in failures[1:]:
        total = total.bitwiseOR(one)
    rows = measured(docs.select(*other_columns(docs, ["failures"])), text)
    return rows.withColumn("failures", total)


def decide(rows: DataFrame, policy: Policy = POLICIES[-1]) -> DataFrame:
    """A ledger's rows with ``kept`` under the policy."""
    return rows.withColumn("kept", ~policy.rejects(F.col("failures")))


def patterns(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many rows have each pattern of failures; at most 2 to the number of rules for each group, summed before the shuffle."""
    return rows.groupBy(*by, "failures").agg(F.count(F.lit(1)).alias("n"))


def failed_rules(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``some`` and ``all``: the rules that any and that every row of a group fails, ``odd``: those failed an odd number of times."""
    return rows.groupBy(*by).agg(F.bit_or("failures").alias("some"), F.bit_and("failures").alias("all"), F.bit_xor("failures").alias("odd"))


def ablations(rows: DataFrame, policies: Sequence[Policy] = tuple(POLICIES), by: Sequence[str] = ()) -> DataFrame:
    """What each rule does to each policy: ``version, rule, n, failed, rejected, only``, and the group's columns.

    ``failed`` counts the rows that fail the rule, ``rejected`` those that the policy rejects, ``only`` those that it
    would keep without this rule. Texts aren't read: the patterns of failures are counted once, and every policy and
    rule clears its bit in them.
    """
    cells = []
    for policy in policies:
        for i, name in enumerate(RULES):
            left = Policy(policy.version, policy.hard & ~(1 << i), policy.soft & ~(1 << i), policy.least)
            failures = F.col("failures")
            cells.append(F.struct(
                F.lit(policy.version).alias("version"), F.lit(name).alias("rule"), (failures.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0).alias("fails"),
                policy.rejects(failures).alias("out"), left.rejects(failures).alias("still")))
    spread = patterns(rows, by).select(*by, "n", F.inline(F.array(*cells)))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return spread.groupBy(*by, "version", "rule").agg(
        F.sum("n").alias("n"), count(F.col("fails")).alias("failed"), count(F.col("out")).alias("rejected"),
        count(F.col("out") & ~F.col("still")).alias("only"))
