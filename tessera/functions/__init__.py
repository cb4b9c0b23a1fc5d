from tessera.functions.scalar import (  # noqa: F401
    cell_text,
    epoch_micros,
    equals_ignore_case,
    history_key,
    java_string_hash,
    jvm_trim,
    levenshtein,
    parse_date,
    salted_row_key,
    split_names,
    ts_to_int,
    translate_joda_pattern,
)
