"""Event catalogue of a server: extract, de-duplicate, label."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from palaver.operators import events, prompts
from palaver.operators.ordering import materialise
from palaver.sources.tables import Tables


def raw_catalogue(
    tables: Tables, server_id: int | None, channels: events.ChannelSet, strict_case: bool = False
) -> DataFrame:
    """De-duplicated events of the configured channels; sports posts are labelled already.

    Without a ``server_id`` every server gets its own catalogue.
    """
    found = events.collect_channel_sets(tables, server_id, channels, strict_case)
    return events.dedup_events(found, by=["server_id"] if server_id is None else [])


def label_with_model(
    catalogue: DataFrame,
    model: Callable[[str], str] | None = None,
    allowed: Sequence[str] | None = None,
) -> DataFrame:
    """Label the open events in batches; without a model they are "other"."""
    labelled, open_events = events.split_prelabelled(catalogue)
    if model is None:
        return labelled.unionByName(events.label_missing_as_other(open_events))
    batches = prompts.event_batches(open_events)
    # Answers are written down, so that no later step asks the model again.
    answers = materialise(
        prompts.apply_model(prompts.event_batch_prompts(batches), model, on_error="")
    )
    parsed = prompts.parse_labels(batches, answers, allowed)
    return labelled.unionByName(parsed.drop("batch_no", "batch_pos"))
