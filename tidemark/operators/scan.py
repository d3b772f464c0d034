"""Line-level scan of texts for credentials and environment identifiers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule name -> pattern.  No look-around, so the patterns mean the
# same in every common regex engine.
SECRET_RULES: Mapping[str, str] = {
    "azure-storage-key": r"(?i)AccountKey=[A-Za-z0-9+/]{32,}={0,2}",
    "sas-signature": r"(?i)(?:[?&;]|^)sig=[A-Za-z0-9%+/]{20,}",
    "github-token": r"(?:\bgh(?:p|o|u|s|r)_[A-Za-z0-9]{20,}\b|\bgithub_pat_[A-Za-z0-9_]{20,}\b)",
    "databricks-token": r"(?i)\bdapi[a-f0-9]{20,}\b",
    "jwt": r"\beyJ[A-Za-z0-9_-]{12,}\.[A-Za-z0-9_-]{12,}\.[A-Za-z0-9_-]{8,}\b",
    "private-key": r"-----BEGIN (?:ENCRYPTED |RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "literal-secret": r"(?i)(?:client[_-]?secret|password|pwd|access[_-]?token)\s*[:=]\s*[\"']"
                      r"[^<$%{][^\"'\r\n]{7,}[\"']",
    "literal-bearer": r"(?i)Authorization\s*[:=]\s*[\"']Bearer\s+[A-Za-z0-9._~+/-]{16,}",
    "live-environment-guid": r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}"
                             r"-[89ab][0-9a-f]{3}-[0-9a-f]{12}\b",
    "snowflake-snowsight-account-url":
        r"(?i)https://app\.snowflake\.com/[a-z0-9_-]+/[a-z0-9_-]+(?:/|\b)",
    "snowflake-account-host":
        r"(?i)\b[a-z0-9_-]+(?:\.[a-z0-9_-]+)*\.(?:privatelink\.)?snowflakecomputing\.(?:com|cn)\b",
}

# Known test literals that are never findings.
SAFE_LITERALS: Sequence[str] = (
    "github_pat_synthetic_test_value",
    "Org-Account.snowflakecomputing.com",
    "Org-Account.privatelink.snowflakecomputing.com",
    "org-account.snowflakecomputing.com",
    "org-account.privatelink.snowflakecomputing.com",
    "acme-demo.snowflakecomputing.com",
)
# Fixed value: what a known literal is replaced by.
SAFE_REPLACEMENT = "<known-test-fixture>"

# A user rule for tokens assigned as 40 hex digits.
HEX_TOKEN_RULE: Mapping[str, str] = {"hex-token": r"\btoken\s*=\s*\"[0-9a-f]{40}\""}

# Words, in lower case, one of which is in every match of a rule whatever its
# letter case.  A rule without an entry is tried on every text.
REQUIRED_WORDS: Mapping[str, Sequence[str]] = {
    "azure-storage-key": ("accountkey=",),
    "sas-signature": ("sig=",),
    "github-token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_"),
    "databricks-token": ("dapi",),
    "jwt": ("eyj",),
    "private-key": ("private key-----",),
    "literal-secret": ("secret", "password", "pwd", "access"),
    "literal-bearer": ("authorization",),
    "snowflake-snowsight-account-url": ("https://app.snowflake.com/",),
    "snowflake-account-host": ("snowflakecomputing.",),
    "hex-token": ("token",),
}

LINE_BREAK = "\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029]"


def scan_text(df: DataFrame, label: str, text: str,
              rules: Mapping[str, str] = SECRET_RULES,
              extra_rules: Mapping[str, str] | None = None,
              safe_literals: Sequence[str] = SAFE_LITERALS,
              required_words: Mapping[str, Sequence[str]] = REQUIRED_WORDS) -> DataFrame:
    """One row per (label, line, rule) where a rule matches the line.

    A text is split into lines only for the rules that can match somewhere in
    it, which plain word searches rule out for most; clean texts never leave the
    scan.  The rules are part of the projection: there is no join and no
    shuffle, and a text is always searched as a whole.
    """
    rules = {**rules, **(extra_rules or {})}
    blanked = F.col(text)
    for literal in safe_literals:
        blanked = F.replace(blanked, F.lit(literal), F.lit(SAFE_REPLACEMENT))
    texts = df.select(F.col(label), blanked.alias("_text"))
    texts = texts.withColumn("_folded", F.lower("_text"))
    possible = F.array_compact(F.array(*[
        F.when(_may_match(pattern, *_known(name, pattern, required_words)), F.lit(name))
        for name, pattern in rules.items()]))
    texts = texts.withColumn("_possible", possible)
    lines = texts.select(label, "_possible", F.posexplode(
        F.when(F.size("_possible") > 0, F.split("_text", LINE_BREAK))
    ).alias("_position", "_line"))
    hits = F.array_compact(F.array(*[
        F.when(F.array_contains("_possible", name) & F.col("_line").rlike(pattern), F.lit(name))
        for name, pattern in rules.items()]))
    return lines.select(label, (F.col("_position") + 1).alias("line"),
                        F.explode(hits).alias("rule"))


def _known(name: str, pattern: str, required_words: Mapping[str, Sequence[str]]) -> tuple[Sequence[str], bool]:
    """The words a rule needs, and whether the pattern is the library's own.  Its words say
    nothing about another pattern that a caller gives the same name."""
    own = pattern in (SECRET_RULES.get(name), HEX_TOKEN_RULE.get(name))
    words = required_words.get(name, ()) if own or required_words is not REQUIRED_WORDS else ()
    return words, own and name in SECRET_RULES


def _may_match(pattern: str, words: Sequence[str], own: bool) -> Column:
    """True for every text with a matching line, and possibly for others.

    A pattern is tried on the whole text only if it is one of the library's own
    without anchors: what it matches in a line it then matches in the text.  A
    caller's pattern may look at the line's ends in many ways, so its texts are
    always split.
    """
    anywhere = F.col("_text").rlike(pattern) if own and not re.search(r"[$]|(?<!\[)\^", pattern) else F.lit(True)
    if not words:
        return anywhere
    present = F.col("_folded").contains(words[0])
    for word in words[1:]:
        present = present | F.col("_folded").contains(word)
    return present & anywhere


def format_findings(findings: DataFrame, label: str) -> DataFrame:
    """Findings as ``label:line: rule``."""
    return findings.select(F.concat_ws(
        "", F.col(label).cast("string"), F.lit(":"), F.col("line").cast("string"),
        F.lit(": "), "rule").alias("finding"))
