from ebbline.functions.values import (
    as_double,
    as_int,
    blank_to_null,
    is_missing,
    is_null_like_text,
    label_text,
    parse_timestamp,
    psi_status,
    share,
)

__all__ = [
    "as_double",
    "as_int",
    "blank_to_null",
    "is_missing",
    "is_null_like_text",
    "label_text",
    "parse_timestamp",
    "psi_status",
    "share",
]
