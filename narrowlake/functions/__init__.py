from narrowlake.functions.cells import decode_cell, decode_regex, encode_cell, encode_cell_sql
from narrowlake.functions.dates import as_date
from narrowlake.functions.files import ingest_ts, looks_like_csv, sample_md5

__all__ = [
    "as_date",
    "decode_cell",
    "decode_regex",
    "encode_cell",
    "encode_cell_sql",
    "ingest_ts",
    "looks_like_csv",
    "sample_md5",
]
