from tessera.sinks.tables import (  # noqa: F401
    create_external_table, insert_into, save_table, temp_view, write_csv, write_files, write_json,
)
