"""Payloads that could not be read, set apart with the reason instead of becoming NULLs."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

#: Why a payload is set apart.
MISSING, MALFORMED, MISTYPED, OTHER = "missing", "malformed", "mistyped", "other content"
TEXT, PROBLEM = "payload_text", "problem"
_CORRUPT = "_corrupt"


def examined(payloads: DataFrame, schema: str, expected: str) -> DataFrame:
    """The payloads parsed by the schema, with the text in ``payload_text`` and what is wrong with it in ``problem``.

    One parse gives both: the parser keeps a text that it could not read, or not as the schema says, beside the fields that
    it could. ``expected`` is the field that an answer has at least: a text without it answers something else, as an error
    does. ``problem`` is NULL for an answer, else one of ``missing`` (no text or white space only), ``malformed`` (no
    JSON), ``mistyped`` (a value of another type) and ``other content``.
    """
    parsed = F.from_json("payload", f"{schema}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    text, corrupt = F.col(TEXT), F.col(f"payload.{_CORRUPT}")
    problem = (
        F.when(text.isNull() | text.rlike(r"\A\s*\z"), MISSING)
        .when(corrupt.isNotNull() & F.get_json_object(text, "$").isNull(), MALFORMED)
        .when(corrupt.isNotNull(), MISTYPED)
        .when(F.col(f"payload.{expected}").isNull(), OTHER)
    )
    return payloads.withColumns({TEXT: F.col("payload"), "payload": parsed}).withColumn(PROBLEM, problem)


def answers(checked: DataFrame) -> DataFrame:
    """The payloads to go on with: all but those without readable JSON; fields of another type are NULL in them."""
    return checked.filter(F.col(PROBLEM).isNull() | F.col(PROBLEM).isin(MISTYPED, OTHER)).drop(TEXT, PROBLEM)


def set_apart(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, problem, payload_text): what is set apart."""
    return checked.filter(F.col(PROBLEM).isNotNull()).select(*keys, PROBLEM, TEXT)


def counted(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and the numbers of problems that whatever reads it will have met."""
    seen = Observation()
    counts = [F.count_if(F.col(PROBLEM) == p).alias(p) for p in (MISSING, MALFORMED, MISTYPED, OTHER)]
    return checked.observe(seen, F.count(F.lit(1)).alias("payloads"), *counts), seen


def report(checked: DataFrame) -> DataFrame:
    """Problems by falling frequency."""
    return set_apart(checked, []).groupBy(PROBLEM).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), PROBLEM)
