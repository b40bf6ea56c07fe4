"""A load job as DataFrames: messages in, typed rows and rejects out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.operators import filters
from jsonflow.operators.decode import DOC, RAW, decode
from jsonflow.operators.project import REJECTS, project, project_messages
from jsonflow.plans.spec import LoadSpec, quoted

STAGE = "_stage"


def load_rows(
    messages: DataFrame, spec: LoadSpec, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Typed rows of the messages that parse and pass the filter; a single narrow stage."""
    if filters.is_off(spec.filter):
        return project_messages(messages, spec.mapping, keep, spec.epoch_numbers, value)
    return decoded_rows(decode(messages, value, keep), spec, keep)


def decoded_rows(decoded: DataFrame, spec: LoadSpec, keep: Sequence[str] = ()) -> DataFrame:
    """``load_rows`` for messages that are parsed already, for instance for several jobs."""
    kept = filters.keep_matching(decoded, spec.filter)
    return project(kept, spec.mapping, keep, spec.epoch_numbers)


def classify(decoded: DataFrame, spec: LoadSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Rows and rejects of one pass over parsed messages.

    Mapped columns, then ``_stage`` (NULL, ``coerce`` or ``decode``), ``_rejects`` (the
    reasons) and ``_raw`` (the message, for rejects only). A row with fields that did not
    fit is still a row: those fields are NULL. Messages the filter drops are not included.
    """
    if not filters.is_off(spec.filter):
        # Malformed messages cannot be judged; they go on as rejects.
        judged = filters.with_verdict(decoded, spec.filter)
        bad = F.col(DOC).isNull()
        decoded = judged.filter(bad | F.col(filters.VERDICT)).drop(filters.VERDICT)
    typed = project(
        decoded.withColumn("_bad", F.col(DOC).isNull()),
        spec.mapping,
        [*keep, RAW, "_bad"],
        spec.epoch_numbers,
        rejects=True,
    )
    # As in decode: the explode keeps conditions on the rejects from being unfolded into all
    # the conversions they came from.
    carried = [c for c in typed.columns if c != REJECTS]
    typed = typed.select(*map(quoted, carried), F.explode(F.array(REJECTS)).alias(REJECTS))
    stage = F.when(F.col("_bad"), "decode").when(F.size(REJECTS) > 0, "coerce")
    reasons = F.when(F.col("_bad"), F.array(F.lit("malformed JSON"))).otherwise(F.col(REJECTS))
    raw = F.when(stage.isNotNull(), F.col(RAW))
    return typed.withColumns({STAGE: stage, REJECTS: reasons, RAW: raw}).drop("_bad")


def rows_of(classified: DataFrame, spec: LoadSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The rows to load: all but the malformed messages."""
    loaded = classified.filter(F.col(STAGE).isNull() | (F.col(STAGE) != "decode"))
    return loaded.select(*keep, *[quoted(m.column) for m in spec.mapping])


def rejects_of(classified: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rejects as ``value, stage, reason``, one row per reason."""
    bad = classified.filter(F.col(STAGE).isNotNull())
    return bad.select(
        *keep,
        F.col(RAW).alias("value"),
        F.col(STAGE).alias("stage"),
        F.explode(REJECTS).alias("reason"),
    )


def reject_counts(classified: DataFrame) -> DataFrame:
    """How many fields or messages were rejected, by stage and reason."""
    bad = classified.filter(F.col(STAGE).isNotNull())
    reasons = bad.select(F.col(STAGE).alias("stage"), F.explode(REJECTS).alias("reason"))
    return reasons.groupBy("stage", "reason").agg(F.count("*").alias("rejects"))

