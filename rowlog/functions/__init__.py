from rowlog.functions.fingerprint import fingerprint, query_hash
from rowlog.functions.images import (
    all_columns,
    cell_literal,
    changed_columns,
    changed_index,
    image_col,
    image_has,
    json_string,
    quoted_names,
    row_diff,
    row_image,
    typed_image,
)
from rowlog.functions.text import (
    change_pk,
    file_base,
    gtid_txn,
    gtid_txn_text,
    gtid_uuid,
    op_class,
    output_name,
    padded_seq,
    parse_long,
    qualified_table,
    table_key,
)
from rowlog.functions.time import (
    epoch_millis,
    ntz_from_millis,
    parse_time_text,
    typed_instant,
    utc_millis,
    utc_seconds,
)
