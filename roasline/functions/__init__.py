from roasline.functions.columns import (  # noqa: F401
    DATE_FORMATS,
    add_parts,
    exact_sum_parts,
    join_parts,
    parts_value,
    sum_parts,
    divide_sql,
    units_sql,
    NUMERIC_TEXT,
    clean_numeric,
    first_existing,
    fmt_fixed,
    money,
    numeric_columns,
    parse_date,
    round_decimal,
    round_half_even,
    safe_divide,
    text_or,
    zero_if_bad,
)
