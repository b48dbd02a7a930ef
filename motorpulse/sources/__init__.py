from .messages import (
    FileTopic,
    FileTopics,
    KafkaTopic,
    available_topics,
    merge_topics,
    split_topics,
)
from .tables import (
    EmptyTableError,
    MissingColumnsError,
    literal_table,
    read_table,
    require_columns,
    require_rows,
)

__all__ = [
    "EmptyTableError",
    "FileTopic",
    "FileTopics",
    "KafkaTopic",
    "MissingColumnsError",
    "available_topics",
    "literal_table",
    "merge_topics",
    "read_table",
    "require_columns",
    "require_rows",
    "split_topics",
]
