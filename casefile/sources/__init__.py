from casefile.sources.tables import (  # noqa: F401
    demo_blobs,
    load_table,
    save_records_json,
    save_result_csv,
    save_table,
)
