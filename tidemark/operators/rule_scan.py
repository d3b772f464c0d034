"""Text scan by rules that are data: thousands of them in one pass over the texts.

Every rule states words, one of which is in each of its matches.  One automaton of all
words runs over a text and tells on which lines which rules can match at all; only these
pairs of a line and a rule leave the pass, and Spark's own matcher decides them, joined to
the rule's pattern.  The cost of a text does not grow with the number of rules.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scan import LINE_BREAK, REQUIRED_WORDS, SAFE_LITERALS, SAFE_REPLACEMENT, SECRET_RULES

MOST_RULE_BYTES = 16 << 20
SUSPECTS = "line int, content string, rule string"


class RuleError(ValueError):
    pass


def library_rules(spark: SparkSession) -> DataFrame:
    """The library's rules as rows (rule, pattern, words); rules that need no word are left
    to ``scan_text``."""
    rows = [(name, pattern, list(REQUIRED_WORDS[name]))
            for name, pattern in SECRET_RULES.items() if name in REQUIRED_WORDS]
    return spark.createDataFrame(rows, "rule string, pattern string, words array<string>")


def scan_with_rules(df: DataFrame, label: str, text: str, rules: DataFrame,
                    safe_literals: tuple[str, ...] = tuple(SAFE_LITERALS),
                    most_rule_bytes: int = MOST_RULE_BYTES) -> DataFrame:
    """One row per (label, line, rule) where a rule matches the line.

    ``rules`` has a row (rule, pattern, words) for each rule; a rule without words, a name
    that comes twice, or rules of more than ``most_rule_bytes`` in all, which every
    task holds, are refused.  Null texts have no lines.  Texts are not shuffled.
    """
    size = rules.agg(
        F.coalesce(F.sum(F.length("pattern") + F.length("rule") + F.length(F.array_join("words", " "))), F.lit(0)).alias("bytes"),
        (F.count("*") - F.count_distinct("rule")).alias("twice"),
        F.count_if(F.coalesce(F.size("words"), F.lit(0)) <= 0).alias("wordless")).first()
    if size["wordless"] or size["twice"] or size["bytes"] > most_rule_bytes:
        raise RuleError(f"{size['wordless']} rules without words, {size['twice']} repeated names, {size['bytes']} bytes")
    words: dict[str, list[str]] = {}
    for row in rules.select("rule", F.explode("words").alias("word")).collect():
        words.setdefault(row["word"].lower(), []).append(row["rule"])
    kind = df.schema[label].dataType.simpleString()

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick  # needed by the tasks of this scan only

        automaton = ahocorasick.Automaton()
        for word, names in words.items():
            automaton.add_word(word, (len(word), names))
        if words:
            automaton.make_automaton()
        ends = re.compile(LINE_BREAK)
        for batch in batches:
            rows, numbers, contents, names = [], [], [], []
            for row, content in enumerate(batch.column("text").to_pylist() if words else []):
                # Lower case may change lengths but no line breaks, so lines keep their numbers.
                folded = (content or "").lower()
                hits = [(end - length + 1, own) for end, (length, own) in automaton.iter(folded)]
                if not hits:
                    continue
                starts = [m.end() for m in ends.finditer(folded)]
                lines = ends.split(content)
                found = {(bisect_right(starts, at), name) for at, own in hits for name in own}
                for number, name in sorted(found):
                    rows.append(row)
                    numbers.append(number + 1)
                    contents.append(lines[number])
                    names.append(name)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(pa.array(rows)), pa.array(numbers, pa.int32()), pa.array(contents, pa.string()),
                     pa.array(names, pa.string())], ["label", "line", "content", "rule"])

    blanked = F.col(text)
    for literal in safe_literals:
        blanked = F.replace(blanked, F.lit(literal), F.lit(SAFE_REPLACEMENT))
    found = df.select(F.col(label).alias("label"), blanked.alias("text")).mapInArrow(suspects, f"label {kind}, {SUSPECTS}")
    # Bounded above, like what every task holds.
    patterns = F.broadcast(rules.select("rule", "pattern"))
    return (found.join(patterns, "rule").filter(F.expr("content rlike pattern"))
            .select(F.col("label").alias(label), "line", "rule"))
