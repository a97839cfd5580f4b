"""Credential redaction in text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from chatlog.functions.text import as_col

# Named fields that are masked wherever they stand: name -> pattern of the value.
FIELDS = {"sid": r"[^\"';\s]+", "userId": r"\d+", "token": r"[^\"';\s]+"}
MASK = "***"

# --- the words of a shell command, as a grammar of patterns ----------------------------
ESCAPE = r"\\[\s\S]"
DOUBLE = rf'"(?:{ESCAPE}|[^"\\])*+"?'
SINGLE = r"'[^']*+'?"
ANSI = rf"\$'(?:{ESCAPE}|[^'\\])*+'?"
PART = rf"(?:{DOUBLE}|{ANSI}|{SINGLE}|{ESCAPE}|[^\s\"'\\])"  # a word is parts without a space between them
GAP = r"(?:\s|\\\r?\n)++"  # also the end of a line that goes on
NAME = r"\s*+(?i:cookie)\s*+:"
# -b and --cookie, apart, with =, glued to the word, or last of several short options.
OPTION = rf"(?:(?:b|-cookie)(?:{GAP}|=)|b(?=[\"'$\\]|[^\s=]*+=)|[A-Za-z]{{1,8}}?b(?:{GAP}|(?=[\"'$\\]))(?=[^\r\n=]*+=)){PART}++"
# -H and --header whose word begins with the name of the header.
HEADER = (
    rf"(?:[A-Za-z]{{0,8}}?H|-header)(?:{GAP}|=)?+"
    rf"""(?:(?="{NAME}){DOUBLE}{PART}*+|(?=\$'{NAME}){ANSI}{PART}*+|(?='{NAME}){SINGLE}{PART}*+|(?i:cookie):[^\r\n]*+)"""
)
# Both begin with a plain character, so that most places of a text are passed at once.
COOKIES = rf"-(?<![\w-]-)(?:{OPTION}|{HEADER})|[Cc](?m:(?<=^.))(?i:ookie):[^\r\n]*+"
# One name=value in what was passed. A value may hold escapes and the quotes of its word or others, but ends before the last one.
VALUE = rf"""(?:{ESCAPE}|["']\$?+["']|["'](?!;|\z)|[^;"'\\\r\n])*+"""
PAIR = (
    r"""(?:(?<![\w-])|(?<=^-b))([^\s;:=,"'\\-][^\s;=,"'\\]*+=["']?)"""
    rf"""(?:(?<=")[^"\r\n]*+|(?<=')[^'\r\n]*+|\\["'](?:(?!\\["'])[^\r\n])*+|{VALUE})"""
)
# Marks of where a passage begins or ends and of each pair in it: characters that no text may hold.
EDGE, HIT = "\ufdd0", "\ufdd1"


def _pattern(name: str, value: str) -> str:
    """The name as it stands in front, which is searched for as a whole, and then what must stand around it."""
    return rf"""{re.escape(name)}(?<=\b{re.escape(name)})=(["']?){value}"""


def _may_have_cookies(c: Column) -> Column:
    """A cheap look for an option or a header, in front of the regex."""
    clustered = F.contains(c, F.lit("=")) & F.regexp_like(c, F.lit(r"-[A-Za-z]{1,8}b[\s\"'$\\]"))
    return F.contains(c, F.lit("-b")) | F.contains(F.lower(c), F.lit("cookie")) | clustered


def has_cookie_option(c) -> Column:
    """The text holds a pasted command with a cookie option or header, or a cookie header line."""
    c = as_col(c)
    return _may_have_cookies(c) & F.regexp_like(c, F.lit(COOKIES))


def redact_credentials(df: DataFrame, text: str = "text", fields: dict[str, str] | None = None) -> DataFrame:
    """Mask credentials in `text`; add `cookie_hits`, hits per named field and `has_command`.

    Every name=value pair of a cookie option or header is masked, whatever its name, and the
    values of the named fields wherever they occur; no value leaves the operator. Commands are read in
    the words of a shell: quotes of all kinds, escapes, options glued to their word or clustered,
    lines that go on. An open quote ends with the text. Text is searched for commands once, and each
    passage for pairs once. U+FDD0 and U+FDD1, which are no characters, are dropped from a text with a command.
    """
    fields = FIELDS if fields is None else fields
    source = F.col(text)
    clean = F.replace(F.replace(source, F.lit(EDGE)), F.lit(HIT))
    marked = F.regexp_replace(clean, COOKIES, f"{EDGE}$0{EDGE}")
    found = F.when(_may_have_cookies(source), F.split(marked, EDGE, -1))
    df = df.withColumn("_passed", F.coalesce(found, F.array(source)))  # every second entry is a passage
    there = F.size("_passed") > 1
    covered = F.transform("_passed", lambda p, i: F.when(
        i % 2 == 1, F.regexp_replace(p, F.lit(PAIR), F.lit(f"$1{re.escape(MASK)}{HIT}"))).otherwise(p))
    df = df.withColumn("_covered", F.when(there, F.array_join(covered, "")))
    masked = F.when(there, F.replace("_covered", F.lit(HIT))).otherwise(source)
    pairs = F.when(there, F.length("_covered") - F.length(masked)).otherwise(0).cast("bigint")
    hits = {"cookie_hits": pairs}
    for name, value in fields.items():
        pattern, found = _pattern(name, value), F.contains(source, F.lit(f"{name}="))
        hits[f"{name}_hits"] = F.when(found, F.regexp_count(source, F.lit(pattern))).otherwise(0).cast("bigint")
    out = df.withColumns({**hits, "has_command": there}).withColumn("_masked", masked)
    for name, value in fields.items():
        found = F.contains("_masked", F.lit(f"{name}="))
        out = out.withColumn("_masked", F.when(found, F.regexp_replace("_masked", _pattern(name, value), f"{name}=$1{re.escape(MASK)}")).otherwise(F.col("_masked")))
    return out.drop(text, "_passed", "_covered").withColumnRenamed("_masked", text)
