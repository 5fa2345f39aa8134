"""Relations of the record-linkage engine: all source columns are strings, and empty means missing."""

from pyspark.sql import types as T

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
SOURCE = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
CANDIDATES = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "candidate_entity_ids")])

#: Ids kept of a blocking key, candidates kept of an entity, and candidates after which further keys are not read.
MAX_PER_KEY, MAX_PER_ENTITY = 60, 80
MAX_BEFORE_CAP = 3 * MAX_PER_ENTITY


def require(df, *columns: str):
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df
