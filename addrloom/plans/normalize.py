"""The address normalisation job: features and manifest in, canonical strings out."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.operators.compose import input_addresses, join_jobs, required_fields
from addrloom.operators.batches import unique_batches
from addrloom.operators.counters import observe_checked, observe_written, rate
from addrloom.operators.dedupe import BATCH_ROWS, dedupe
from addrloom.operators.records import (
    RECORD_COLUMNS,
    implausible,
    normalise,
    plausible,
    with_canonical,
    with_reason,
)
from addrloom.operators.tables import OUTPUT_COLUMN, Sink
from addrloom.operators.tagging import with_structured_tags
from addrloom.session import materialise, tune
from addrloom.sources.manifest import limit_jobs

Tagger = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunReport:
    """Counters of one run; ``processed = written + deduped + invalids``."""

    processed: int
    written: int
    deduped: int
    invalids: int
    seconds: float

    @property
    def rate_in(self) -> float:
        return rate(self.processed, self.seconds)

    @property
    def rate_out(self) -> float:
        return rate(self.written, self.seconds)


def checked_records(
    features: DataFrame,
    jobs: DataFrame | None,
    *,
    tagger: Tagger = with_structured_tags,
    missing_region: str = "null",
) -> DataFrame:
    """Features to normalised records with ``reason``; no shuffle when the manifest is small.

    Without ``jobs`` the features must carry ``job_country, job_region, job_city`` already.
    """
    wanted = required_fields(features)
    placed = wanted if jobs is None else join_jobs(wanted, jobs)
    tagged = tagger(input_addresses(placed))
    return with_reason(normalise(tagged, missing_region=missing_region))


def canonical_rows(
    checked: DataFrame, *, scope: str | None = "global", all_columns: bool = False
) -> DataFrame:
    """Plausible records with their canonical string, duplicates removed."""
    valid = with_canonical(plausible(checked))
    wanted = [*RECORD_COLUMNS, OUTPUT_COLUMN] if all_columns else [OUTPUT_COLUMN]
    return dedupe(valid.select(*wanted), scope)


def rows_per_batch(
    checked: DataFrame, *, batch_rows: int = BATCH_ROWS, all_columns: bool = False
) -> DataFrame:
    """Plausible records with their canonical string, each once per batch of its job.

    A batch closes with its ``batch_rows``-th row that stays, and the first row of a string stays.
    """
    wanted = [*RECORD_COLUMNS, OUTPUT_COLUMN] if all_columns else [OUTPUT_COLUMN]
    # Stored once: numbering reads the rows more than once.
    valid = materialise(
        with_canonical(plausible(checked)).select("job_id", "line_id", "item", *wanted), "valid-rows"
    )
    return unique_batches(valid, batch_rows=batch_rows).where("kept").select(*wanted)


def normalize_job(
    features: DataFrame,
    manifest: DataFrame,
    *,
    sink: Sink,
    jobs_limit: int | None = None,
    scope: str | None = "global",
    batch_rows: int = BATCH_ROWS,
    all_columns: bool = False,
    tagger: Tagger = with_structured_tags,
    missing_region: str = "null",
    ready_records: DataFrame | None = None,
    rejects: Sink | None = None,
) -> RunReport:
    """Run features to a sink.

    ``ready_records`` are already normalised rows; they join in before the plausibility check.
    ``scope="batch"`` drops duplicates within batches of ``batch_rows`` rows that stay; it needs the
    position columns ``line_id`` and ``item`` in the features. With a ``rejects`` sink the checked records
    are stored once in the shared folder and both sinks read from there.
    """
    started = time.perf_counter()
    tune(features.sparkSession)
    checked = checked_records(
        features, limit_jobs(manifest, jobs_limit), tagger=tagger, missing_region=missing_region
    )
    if ready_records is not None:
        ready = with_reason(ready_records.select(*RECORD_COLUMNS))
        checked = checked.unionByName(ready, allowMissingColumns=True)
        if scope == "batch":
            checked = checked.withColumns(
                {
                    "job_id": F.coalesce("job_id", F.lit("")),
                    "line_id": F.coalesce("line_id", F.monotonically_increasing_id()),
                    "item": F.coalesce("item", F.lit(0)),
                }
            )
    if rejects is not None:
        checked = materialise(checked, "checked")
        rejects(implausible(checked))
    checked, seen = observe_checked(checked)
    if scope == "batch":
        unique = rows_per_batch(checked, batch_rows=batch_rows, all_columns=all_columns)
    else:
        unique = canonical_rows(checked, scope=scope, all_columns=all_columns)
    rows, out = observe_written(unique)
    sink(rows)
    processed, invalids, written = seen.get["processed"], seen.get["invalids"], out.get["written"]
    return RunReport(
        processed=processed,
        written=written,
        deduped=processed - invalids - written,
        invalids=invalids,
        seconds=time.perf_counter() - started,
    )
