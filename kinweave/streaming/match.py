"""Candidates for a stream of new records against an index that stands still: a stateless stream-static join."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kinweave.functions.keys import blocking_keys
from kinweave.functions.normalize import normalize_entities


def stream_candidates(stream: DataFrame, index: DataFrame) -> DataFrame:
    """(s1_id, cand_id) with the key's ord, as records come; write it with foreachBatch to apply the caps an entity."""
    keys = blocking_keys(normalize_entities(stream))
    return keys.selectExpr("entity_id as s1_id", "ord", "key").join(index, "key").select("s1_id", "cand_id", "ord")
