"""Text clean-up for names and log messages."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------------------------
TRUNCATION_MARK = "... [TRUNCATED]"
LOG_MESSAGE_LIMIT = 1000

UNKNOWN_CATEGORY = "UNKNOWN"
# Category -> alternatives, tried in this order. Each alternative is a list of patterns that
# must all occur in the lower-cased message.
ERROR_CATEGORIES: dict[str, list[list[str]]] = {
    "MISSING_PATH": [
        ["path does not exist"],
        ["no such file or directory"],
        ["file not found"],
        ["cannot find path"],
        ["path not found"],
    ],
    "CORRUPT_DELTA": [
        ["is not a delta table"],
        ["failed to merge fields"],
        ["incompatible format"],
        ["protocol", "unsupported"],
        ["delta log", "error"],
        ["cannot find delta log"],
    ],
    "SCHEMA_MISMATCH": [
        ["schema mismatch"],
        ["cannot resolve"],
        ["column not found"],
        ["mismatched input"],
        ["incompatible schema"],
    ],
    "TIMEOUT": [
        ["timeout"],
        ["timed out"],
        ["out of memory"],
        [r"\boom\b"],
        ["resource exhausted"],
        ["deadline exceeded"],
    ],
    "CONNECTION": [
        ["connection refused"],
        ["connection failed"],
        ["network error"],
        ["cannot connect"],
        ["authentication failed"],
        ["login failed"],
        ["connection timeout"],
    ],
}
# --------------------------------------------------------------------------------------------


def safe_identifier(name: Column) -> Column:
    """Column name fit for a table: letters, digits and underscores, not starting with a digit.

    Names without any usable character stay as they are; NULL becomes empty text.
    """
    kept = F.trim(F.regexp_replace(name, "[^0-9A-Za-z_ ]+", ""))
    joined = F.regexp_replace(kept, " +", "_")
    prefixed = F.regexp_replace(joined, "^([0-9])", "_$1")
    # One chain, so that a long name is cleaned once and not once per condition.
    return F.coalesce(F.nullif(prefixed, F.lit("")), name, F.lit(""))


def safe_column_names(names: list[str]) -> list[str]:
    """Safe names for a DataFrame's header; raises when two columns would collide."""
    result = []
    for name in names:
        words = re.sub("[^0-9A-Za-z_ ]+", "", name).split()
        safe = "_".join(words) or name
        result.append(f"_{safe}" if safe[:1].isdigit() else safe)
    repeated = sorted({n for n in result if result.count(n) > 1})
    if repeated:
        raise ValueError(f"column names collide after clean-up: {repeated}")
    return result


def truncate_message(message: Column, limit: int = LOG_MESSAGE_LIMIT, empty: str | None = None) -> Column:
    """Message cut to ``limit`` characters plus a mark; missing or empty text gives ``empty``."""
    cut = F.concat(F.substring(message, 1, limit), F.lit(TRUNCATION_MARK))
    return (F.when(message.isNull() | (message == ""), F.lit(empty).cast("string"))
            .when(F.length(message) <= limit, message)
            .otherwise(cut))


def truncate_text(message: str | None, limit: int = LOG_MESSAGE_LIMIT) -> str | None:
    """Driver-side twin of :func:`truncate_message` for one message."""
    if not message:
        return None
    return message if len(message) <= limit else message[:limit] + TRUNCATION_MARK


def _category_pattern(alternatives: list[list[str]]) -> str:
    """One regular expression per category; several parts become look-aheads over the text."""
    pieces = [parts[0] if len(parts) == 1 else "^" + "".join(f"(?=.*{p})" for p in parts)
              for parts in alternatives]
    return "(?s)" + "|".join(f"(?:{p})" for p in pieces)


def error_category(message: Column) -> Column:
    """Category of an error message; the first category that matches wins."""
    text = F.lower(message)
    chain = None
    for category, alternatives in ERROR_CATEGORIES.items():
        # contains() is a plain byte search; only a word-boundary pattern needs a regex.
        hits = F.lit(False)
        for parts in alternatives:
            every = F.lit(True)
            for part in parts:
                every = every & (text.rlike(part) if "\\b" in part else text.contains(part))
            hits = hits | every
        chain = F.when(hits, category) if chain is None else chain.when(hits, category)
    return chain.otherwise(UNKNOWN_CATEGORY)


def classify_exception(exc: BaseException | str) -> str:
    """Category of one exception on the driver, from the same table as :func:`error_category`."""
    text = str(exc).lower()
    for category, alternatives in ERROR_CATEGORIES.items():
        if re.search(_category_pattern(alternatives), text):
            return category
    return UNKNOWN_CATEGORY
