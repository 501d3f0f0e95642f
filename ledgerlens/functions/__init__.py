from ledgerlens.functions.columns import (  # noqa: F401
    INT_TEXT_RE,
    WEI,
    epoch_day,
    flag_to_bool,
    hex_byte_count,
    is_int_text,
    is_truthy_text,
    label_to_date,
    label_to_ym,
    month_label,
    squash_spaces,
    strict_int,
    to_double,
    truncate_to_long,
    wei,
)
