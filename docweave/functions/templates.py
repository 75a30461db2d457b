"""Prompt templates with named ``{slot}`` fields, filled by Column expressions.

``{{`` and ``}}`` are literal braces (as in Python ``str.format``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN, _CLOSE = "\u0003", "\u0004"

# The prompt templates of the plan (type -> template).
PROMPT_TEMPLATES = {
    "definition": (
        "Context: {context}\n"
        "Question: What is {concept}?\n"
        "Consider the definition and key properties when answering.\n"
        "Answer: "),
    "relationship": (
        "Context: {context}\n"
        "Question: How are {concept1} and {concept2} related?\n"
        "Consider both direct and indirect relationships.\n"
        "Answer: "),
    "reasoning": (
        "Context: {context}\n"
        "Question: {question}\n"
        "Consider the following aspects:\n"
        "1. Direct relationships between concepts\n"
        "2. Implied connections\n"
        "3. Domain-specific rules\n"
        "Answer: "),
}

SLOTS = ("context", "concept", "concept1", "concept2", "question")


def templates_frame(spark: SparkSession, templates: dict | None = None) -> DataFrame:
    t = templates or PROMPT_TEMPLATES
    return spark.createDataFrame(sorted(t.items()), "name string, template string")


def pieces(template: Column | str) -> Column:
    """A template cut into texts and ``{slot}`` fields, in order. Made once per template,
    not per filled row, where templates are a table of their own."""
    t = F.col(template) if isinstance(template, str) else template
    masked = F.replace(F.replace(t, F.lit("{{"), F.lit(_OPEN)), F.lit("}}"), F.lit(_CLOSE))
    found = F.regexp_extract_all(masked, F.lit(r"\{(?:" + "|".join(SLOTS) + r")\}|[^{]+|\{"), F.lit(0))
    return F.transform(found, lambda p: F.replace(F.replace(p, F.lit(_OPEN), F.lit("{")), F.lit(_CLOSE), F.lit("}")))


def fill_pieces(parts: Column | str, values: dict[str, Column]) -> Column:
    """Every ``{slot}`` replaced by its value (null value -> empty text); a value is
    never expanded again."""
    def one(p: Column) -> Column:
        out = None
        for slot, val in values.items():
            out = (F if out is None else out).when(p == F.lit("{" + slot + "}"), F.coalesce(val.cast("string"), F.lit("")))
        return p if out is None else out.otherwise(p)
    return F.array_join(F.transform(F.col(parts) if isinstance(parts, str) else parts, one), "")


def fill(template: Column | str, values: dict[str, Column]) -> Column:
    """Replace every ``{slot}`` of a template by its value (see ``fill_pieces``)."""
    return fill_pieces(pieces(template), values)


def render_messages(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit(": "), text)
