from tidemark.sources.files import (
    empty,
    export,
    file_stream,
    frames_by_schema,
    parquet_stream,
    read_snapshot,
    write_clustered,
    write_snapshot,
)
from tidemark.sources.landing import (
    domain_of,
    landing_changes,
    landing_files,
    landing_stream,
    load_summary,
    numbered,
    parse_landing,
    read_landing,
    select_files,
    split_files,
    with_domain,
)
from tidemark.sources.topics import (
    RateLimits,
    decode_avro,
    decode_json,
    registry_schema,
    source_stream,
    topic_batch,
    topic_stream,
)

__all__ = [
    "RateLimits",
    "decode_avro",
    "decode_json",
    "domain_of",
    "empty",
    "export",
    "file_stream",
    "frames_by_schema",
    "landing_changes",
    "landing_files",
    "landing_stream",
    "load_summary",
    "numbered",
    "parquet_stream",
    "parse_landing",
    "read_landing",
    "read_snapshot",
    "registry_schema",
    "select_files",
    "source_stream",
    "split_files",
    "topic_batch",
    "topic_stream",
    "with_domain",
    "write_clustered",
    "write_snapshot",
]
