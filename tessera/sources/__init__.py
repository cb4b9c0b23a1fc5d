from tessera.sources.files import (  # noqa: F401
    read_csv_header, read_csv_schema, read_json, read_multi_path, read_parquet, string_schema,
)
from tessera.sources.sql import from_literals, load, named_query, run_sql  # noqa: F401
