"""Stored free-text responses to structured decisions.

All steps are expressions over a single row: a response never leaves its row, so
the whole job is a chain of projections without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden import policies as P
from eventwarden.functions import columns as X

# Texts and defaults of an incomplete response.
NO_DECISION = "No decision made"
NO_REASONING = "No reasoning provided"
FAILED_DECISION = "Error in decision making - manual review required"
FAILED_REASONING = "Failed to parse LLM response"
DEFAULT_CONFIDENCE_TEXT = "0.7"
UNREADABLE_CONFIDENCE = 0.5
MAX_HEADER = 20

# Unicode white space.
SPACE = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
         "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# A quote opens a text behind a brace, bracket, comma or colon and any blanks, a brace opens an object before such
# a quote or a closing brace.  Both are marked before the text is cut into tokens.
MARK = "\x01"
OPENING_QUOTE = r"([\[{,:]\s*+)([\"'])"
OPENING_BRACE = r"(\{)(?=\s*+[\x01}])"
TOKEN = r"\\.|\x01[{\"']|[{}\"'\n]|[^{}\"'\n\\\x01]++|[\\\x01]"


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(text, F.lit(SPACE))


def with_sections(df: DataFrame, text: str, out: str = "_parts") -> DataFrame:
    """Add ``array<struct<name, body>>`` in order of appearance.

    A line ending in a colon and shorter than 20 characters opens a section;
    text before the first one, or under an empty name, belongs to none.  The
    lines and the header positions are columns of their own: an expression
    used inside a lambda would be evaluated again for every element.
    """
    def is_header(line: Column) -> Column:
        return line.endswith(":") & (F.length(line) < MAX_HEADER)

    headers = F.transform("_lines", lambda l, i: F.when(is_header(l), i + 1))
    end = lambda k: F.coalesce(F.get("_starts", k + 1), F.size("_lines") + 1)
    parts = F.transform("_starts", lambda at, k: F.struct(
        F.lower(F.regexp_replace(F.get("_lines", at - 1), ":$", "")).alias("name"),
        F.array_join(F.slice("_lines", at + 1, end(k) - at - 1), "\n").alias("body")))
    return (df.withColumn("_lines", F.transform(F.split(F.col(text), "\n", -1), strip))
            .withColumn("_starts", F.array_compact(headers))
            .withColumn(out, parts)
            .drop("_lines", "_starts"))


def section(parts: Column, name: str) -> Column:
    """Body of the last section of that name, null when absent."""
    named = F.filter(parts, lambda s: (s["name"] == name) & (s["name"] != ""))
    return F.try_element_at(named, F.lit(-1))["body"]


def confidence(text: Column) -> Column:
    """First number in the text, clamped to [0, 1]; one half when there is none."""
    number = F.nullif(F.regexp_extract(text, r"\d+\.?\d*", 0), F.lit("")).try_cast("double")
    return F.coalesce(X.clamp01(number), F.lit(UNREADABLE_CONFIDENCE))


def escalation(text: Column) -> Column:
    return F.lower(text).contains("true")


def objects(text: Column) -> Column:
    """The outermost balanced brace groups of a text, of any depth.

    Braces inside quoted texts do not count.  A quoted text ends with its line, and a brace
    that is never closed holds no group, so neither swallows what follows.  One fold over the
    tokens from the first brace on keeps the position, the open braces, the quote and the groups so far.
    """
    body = F.substring(text, F.instr(text, "{"), F.length(text))
    quoted = F.regexp_replace(F.replace(body, F.lit(MARK), F.lit("")), OPENING_QUOTE, "$1" + MARK + "$2")
    marked = F.regexp_replace(quoted, OPENING_BRACE, MARK + "$1")
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("open"), F.lit("").alias("quote"),
                     F.array().cast("array<struct<first:int,last:int>>").alias("found"))

    def step(s: Column, token: Column) -> Column:
        free, size = s["quote"] == "", F.length(token)
        opens, closes = free & (token == MARK + "{"), free & (token == "}") & (F.size(s["open"]) > 0)
        first = F.try_element_at(s["open"], F.lit(-1))
        outer = F.filter(s["found"], lambda g: g["first"] < first)
        return F.struct(
            (s["at"] + size).alias("at"),
            F.when(opens, F.concat(s["open"], F.array(s["at"])))
            .when(closes, F.slice(s["open"], F.lit(1), F.size(s["open"]) - 1)).otherwise(s["open"]).alias("open"),
            F.when(token == "\n", "")
            .when(free & ~opens & (F.size(s["open"]) > 0) & token.startswith(MARK), F.substring(token, 2, 1))
            .when(~free & (size < 3) & ~token.startswith("\\") & token.endswith(s["quote"]), "")
            .otherwise(s["quote"]).alias("quote"),
            F.when(closes, F.concat(outer, F.array(F.struct(first.alias("first"), s["at"].alias("last")))))
            .otherwise(s["found"]).alias("found"))

    groups = F.aggregate(F.regexp_extract_all(marked, F.lit(TOKEN), 0), start, step, lambda s: s["found"])
    found = F.transform(groups, lambda g: F.replace(
        F.substring(marked, g["first"], g["last"] - g["first"] + 1), F.lit(MARK), F.lit("")))
    return F.when(text.contains("{"), found).when(text.isNotNull(), F.array().cast("array<string>"))


def actions(text: Column) -> Column:
    """Tool calls found anywhere in the text, unreadable ones skipped.

    Single quotes are repaired; parameters may be objects of any depth.
    """
    found = objects(text)
    parsed = F.transform(found, lambda m: F.coalesce(
        F.try_parse_json(m), F.try_parse_json(F.replace(m, F.lit("'"), F.lit('"')))))
    calls = F.transform(F.filter(parsed, lambda v: v.isNotNull()), lambda v: F.struct(
        F.try_variant_get(v, "$.tool", "string").alias("tool"),
        F.coalesce(F.to_json(F.try_variant_get(v, "$.params", "variant")), F.lit("{}")).alias("params")))
    return F.filter(calls, lambda a: F.coalesce(F.length(a["tool"]) > 0, F.lit(False)))


def response_sections(responses: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """One row per named section."""
    return (with_sections(responses, text)
            .select(*key, F.posexplode(F.transform("_parts", lambda p: p)).alias("section_no", "s"))
            .filter(F.col("s.name") != "")
            .select(*key, "section_no", "s.name", "s.body"))


def response_actions(responses: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """One row per tool call, with the audit message its tool reports."""
    params = F.col("a.params")
    quarantine = F.concat(F.lit("Quarantine configured for records matching: "),
                          F.coalesce(F.get_json_object(params, "$.filter_condition"), F.lit("")))
    known = F.col("a.tool").isin(P.KNOWN_TOOLS)
    message = (F.when(~known, F.concat(F.lit("Unknown tool: "), F.col("a.tool")))
               .when(F.col("a.tool") == "apply_schema_remap", "Schema remap applied successfully")
               .when(F.col("a.tool") == "quarantine_records", quarantine)
               .when(F.col("a.tool") == "notify_ops", "Notification sent successfully")
               .when(F.col("a.tool") == "retrigger_task", "Retrigger advised")
               .otherwise("Incident logged"))
    return (responses.select(*key, F.posexplode(actions(F.col(text))).alias("action_no", "a"))
            .select(*key, "action_no", F.col("a.tool").alias("tool"), params.alias("params"),
                    known.alias("success"), message.alias("message")))


def response_decisions(responses: DataFrame, key: list[str], text: str = "text",
                       policy: P.DecisionPolicy = P.DecisionPolicy()) -> DataFrame:
    """Structured decision per response, with defaults for missing sections.

    A missing text is a parse failure: confidence 0 and escalation.  Actions
    are kept only at or above the confidence gate.
    """
    parsed = (with_sections(responses.select(*key, F.col(text).alias("_text")), "_text")
              .withColumn("_calls", actions(F.col("_text"))))
    failed = F.col("_text").isNull()

    def part(name: str, default: str) -> Column:
        return F.coalesce(section(F.col("_parts"), name), F.lit(default))

    sure = F.when(failed, 0.0).otherwise(confidence(part("confidence", DEFAULT_CONFIDENCE_TEXT)))
    called = F.col("_calls")
    return (parsed
            .withColumn("confidence", sure)
            .select(
                *key,
                F.when(failed, FAILED_DECISION).otherwise(strip(part("decision", NO_DECISION)))
                .alias("decision"),
                F.when(failed, FAILED_REASONING).otherwise(strip(part("reasoning", NO_REASONING)))
                .alias("reasoning"),
                "confidence",
                F.when(failed, True).otherwise(escalation(part("escalation", "false")))
                .alias("escalation_required"),
                F.coalesce(F.when(F.col("confidence") >= policy.min_confidence, called),
                           F.slice(called, 1, 0), F.array().cast("array<struct<tool:string,params:string>>"))
                .alias("actions")))
