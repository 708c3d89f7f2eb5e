from loadsmith.functions.columns import (
    blank_as_null,
    changed_flag,
    null_default,
    round_to_bigint,
    typed_null,
)

__all__ = ["blank_as_null", "changed_flag", "null_default", "round_to_bigint", "typed_null"]
