from daybook.sources.statement import (  # noqa: F401
    AMOUNT_HEADER,
    STATEMENT_SCHEMA,
    TIME_HEADER,
    coerce_amount,
    format_timestamp,
    parse_timestamp,
    read_statement_csv,
    statement_from_events,
    statement_from_orders,
    write_statement_csv,
)
